"""Quality rules: figures against plain code and SQL, exact tails, the promised risk, edge cases."""

import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from tests_sql import same_rows
from vecshelf.llm import rules
from vecshelf.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"
WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    words, places, seen, repeated, lines = re.findall(WORD, text), {}, set(), 0, 0
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(8)}
    for line in text.split("\n"):
        if re.search(WORD, line):
            lines += 1
            repeated += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, repeated, len(covered)]


def test_figures_against_plain_code(spark):
    rng = random.Random(1)
    texts = ["", " \n\t", "a", "a " * 9, "x y\nx y\n x y\n", "é\x85ü <b>&\x0b", "a b c d e f g h " * 3, "日本 語\r\n" * 5]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(200))) for _ in range(60)]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randrange(300))) for _ in range(60)]
    texts += [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    assert rules.figures(texts).tolist() == [plain(t) for t in texts]
    assert rules.figures([]).tolist() == []


def test_tail_is_exact():
    def exact(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    for n, k, p in [(1, 0, 0.5), (40, 3, 0.2), (300, 1, 0.05), (2000, 7, 0.01), (2000, 0, 0.01)]:
        assert rules.tail(k, n, p) == pytest.approx(float(exact(k, n, Fraction(p))), rel=1e-9)
    assert rules.tail(5, 10, 0.5) == 1.0 and rules.tail(0, 0, 0.5) == 1.0


def test_certified_cutoffs():
    good, bad = np.zeros(4, np.int64), np.zeros(4, np.int64)
    good[0], bad[2] = 1000, 50  # bad documents fail the two strictest of three cutoffs
    assert rules.certified(good, bad, (30, 20, 10), 0.01, 0.001) == 20
    assert rules.certified(good, bad, (30, 20, 10), 0.01, 1e-6) is None  # too few for this error level
    good[2] = 30  # now both reject too many good ones
    assert rules.certified(good, bad, (30, 20, 10), 0.01, 0.001) is None


def test_risk_holds_on_fresh_documents():
    """Over many holdouts a cutoff's true share of rejected good documents exceeds the risk as rarely as promised."""
    rng = np.random.default_rng(3)
    cutoffs, risk, error, broken = tuple(range(20, 0, -1)), 0.05, 0.2, 0
    for _ in range(400):
        levels = np.minimum(rng.geometric(0.2, 800) - 1, 20)  # a good document fails j cutoffs with chance falling in j
        good, bad = np.bincount(levels, minlength=21), np.bincount([20] * 50 + [3] * 300, minlength=21)
        chosen = rules.certified(good, bad, cutoffs, risk, error)
        if chosen is not None:
            broken += 0.8 ** (len(cutoffs) - cutoffs.index(chosen)) > risk  # chance of that many failed cutoffs or more
    assert broken <= 400 * error


def test_query_against_sql(spark, sql):
    same_rows(queries()["op11_quality_rules"](spark, SF), sql, oracle_sql()["op11_quality_rules"])


def test_verdicts_on_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    rows = rules.measured(docs)
    cutoffs = rules.fit(rows, labels)
    judged = rules.judged(rows, cutoffs).where("not base_failed").join(labels, "doc_id")
    kept = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert kept[1, False] <= rules.RISK * kept[1, True] and kept[0, False] > 100
    found = {(r.stratum, r.rule) for r in cutoffs.collect()}
    assert ("=en", "symbols") in found


def test_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n", None), (4, "w # " * 60_000, "en"), (5, " ".join(map(str, range(40))), None),
            (5, " ".join(map(str, range(40))), None), (None, "one " * 19, "xx")]
    table = spark.createDataFrame([(*r, "s", True, 3) for r in rows],
                                  "doc_id long, text string, lang string, stratum string, kept boolean, n_words int")
    labels = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 0)], "doc_id long, quality int")
    found = {r.doc_id: r for r in rules.checked(table, labels).collect()}
    assert rules.checked(table, labels).count() == len(rows)
    assert not found[1].kept and found[1].base_failed and found[3].n_words == 0
    assert found[4].base_failed and found[4].n_repeat_words == 120_000 and found[4].n_symbols == 60_000
    assert found[5].kept and not found[5].base_failed and found[None].n_words == 19 and not found[None].kept
    assert rules.checked(table.limit(0), labels).collect() == []
    assert rules.checked(table, labels.limit(0)).where("kept").count() == 2
