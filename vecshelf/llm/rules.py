"""Quality rules whose cutoffs come from labelled documents with a guaranteed risk.

A rule rejects documents whose ratio of two figures lies above a cutoff. For each rule and stratum a
fixed grid of cutoffs is tested from the loosest to the strictest: a cutoff is certified if, were the share
of good documents that it rejects above the rule's risk, so few rejections among the good ones of the
holdout would have a chance of at most the error level (an exact binomial tail). Testing stops at the
first cutoff that fails, so the grid needs no correction; strata and rules do, and share the error level
evenly (Bonferroni). The risk of a stratum is shared evenly by the rules. With probability 1 - ERROR, all
strata at once reject at most RISK of their good documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log, log1p
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import coded, small_side, text_of, text_slices, tidy
from vecshelf.session import durable

WINDOW = 8  # words
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words
SYMBOLS = b"#*$%&|<>"
RISK = 0.05  # of a stratum: share of good documents that all rules together may reject
ERROR = 0.05  # chance that the risk of any stratum is exceeded
BLOCK_BYTES = 1 << 20
FIGURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    """Rejects where 100 * over > cutoff * under; cutoffs run from the loosest to the strictest."""

    name: str
    over: str
    under: str
    cutoffs: tuple[int, ...]


RULES = (
    Rule("symbols", "n_symbols", "n_words", (400, 300, 200, 150, 100, 80, 60, 50, 40, 30, 25, 20, 15, 10, 8, 6, 5, 4, 3, 2, 1)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (90, 80, 70, 60, 50, 40, 30, 25, 20, 15, 10, 5)),
    Rule("repeated_words", "n_repeat_words", "n_words", (28, 26, 24, 22, 20, 18, 16, 14, 12, 10, 8, 6, 4, 2)),
    Rule("long_words", "word_chars", "n_words", (2000, 1500, 1200, 1100, 1000, 950, 900, 850, 800, 775, 750, 725, 700)),
    Rule("short_words", "minus_chars", "n_words", (-150, -200, -225, -250, -275, -300, -325, -350, -375, -400)),
)


def figures(texts: list[str]) -> np.ndarray:
    """The FIGURES of whole texts, one row a text."""
    raw = [t.encode() for t in texts]
    split = [t.split() for t in raw]  # bytes split at the six ASCII white-space characters
    n_words = np.array([len(w) for w in split], np.int64)
    found = np.zeros((len(texts), len(FIGURES)), np.int64)
    found[:, 0] = n_words
    for i, (text, data) in enumerate(zip(texts, raw)):
        blanks = len(data) - len(data.translate(None, b" \t\n\x0b\x0c\r"))
        found[i, 1] = len(text) - blanks
        found[i, 2] = len(data) - len(data.translate(None, SYMBOLS))
        lines = [line for line in data.split(b"\n") if line.strip()]
        found[i, 3] = len(lines)
        found[i, 4] = len(lines) - len(set(lines))
    found[:, 5] = repeated_words(split, n_words)
    return found


def repeated_words(split: list[list[bytes]], n_words: np.ndarray) -> np.ndarray:
    """Words in windows of WINDOW words that their text holds twice or more.

    Windows are numbered exactly, by doubling: pairs of numbers of words get numbers, then pairs of those.
    """
    codes, _ = coded([w for words in split for w in words])
    text = np.repeat(np.arange(len(split)), n_words)
    width = 1
    while width < WINDOW:
        if len(codes) <= width:
            return np.zeros(len(split), np.int64)
        base = int(codes.max()) + 1
        codes = pd.factorize(codes[:-width] * base + codes[width:])[0].astype(np.int64)
        width *= 2
    windows = len(codes)
    inside = text[:windows] == text[WINDOW - 1 : WINDOW - 1 + windows]
    at = np.flatnonzero(inside)
    numbers = pd.factorize(codes[at] * len(split) + text[at])[0]
    twice = at[np.bincount(numbers)[numbers] > 1] if len(at) else at
    edges = np.bincount(twice, minlength=len(text) + 1) - np.bincount(twice + WINDOW, minlength=len(text) + 1)[: len(text) + 1]
    covered = np.cumsum(edges)[: len(text)] > 0
    return np.bincount(text[covered], minlength=len(split))


def measured(docs: DataFrame, *, id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """One row per input row: doc_id, stratum, the FIGURES and base_failed. A written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 2, BLOCK_BYTES):
                found = figures(part.column(2).to_pylist())
                columns = [part.column(0), part.column(1), *(pa.array(found[:, i]) for i in range(len(FIGURES)))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "stratum", *FIGURES])

    # A null stratum is one of its own, told apart from every text.
    name = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), name.alias("stratum"), text_of(text).alias("text"))
    schema = ", ".join(["doc_id long, stratum string", *(f"{c} long" for c in FIGURES)])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return durable(rows.mapInArrow(tidy(run), schema).withColumn("base_failed", failed))


def _over(rule: Rule, cutoff: Column | int) -> Column:
    over = -F.col("word_chars") if rule.over == "minus_chars" else F.col(rule.over)
    return 100 * over > cutoff * F.col(rule.under)


def tail(k: int, n: int, p: float) -> float:
    """The chance of at most k of n, each with chance p, for k below n * p; 1 for others."""
    if k >= n * p:
        return 1.0
    last = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p)
    total, term, i = 0.0, 1.0, k
    while i >= 0 and term > 1e-17 * total:  # towards smaller numbers chances fall, ever faster
        total += term
        term *= i * (1 - p) / ((n - i + 1) * p)
        i -= 1
    return float(np.exp(last) * total)


def certified(good: np.ndarray, bad: np.ndarray, cutoffs: tuple[int, ...], risk: float, error: float) -> int | None:
    """The cutoff that tells good from bad best of those certified (the loosest of equals), or None.

    `good` and `bad` count the documents by how many cutoffs they fail.
    """
    above_good, above_bad = np.cumsum(good[::-1]), np.cumsum(bad[::-1])  # a loose cutoff failed: all stricter ones too
    best, gain = None, 0.0
    for i, cutoff in enumerate(cutoffs):
        if tail(int(above_good[i]), int(good.sum()), risk) > error:
            break
        # What the cutoff gains: the share of bad documents less that of good ones.
        told = above_bad[i] / max(1, bad.sum()) - above_good[i] / max(1, good.sum())
        if told > gain + 1e-12:
            best, gain = cutoff, told
    return best


def fit(rows: DataFrame, labels: DataFrame, *, id: str = "doc_id", label: str = "quality", rules: tuple[Rule, ...] = RULES,
        risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Cutoffs per stratum from labelled rows of `measured`: stratum, rule, cutoff, good, bad, tests.

    Rows that fail the base rules do not count, null labels and ids neither; an id with several labels takes the
    rounded mean. All labelled rows count; strata without a certified cutoff of a rule have no row for it.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
        .groupBy(F.col(id).cast("long").alias("doc_id")).agg((F.avg(label) >= 0.5).alias("good"))
    )
    fails = [
        F.struct(F.lit(r.name).alias("rule"), sum((_over(r, c).cast("int") for c in r.cutoffs), F.lit(0)).alias("level"))
        for r in rules
    ]
    counts = durable(
        rows.where(~F.col("base_failed")).join(known, "doc_id")
        .select("stratum", "good", F.explode(F.array(*fails)).alias("f"))
        .groupBy("stratum", "f.rule", "f.level")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    tests = counts.select("stratum").distinct().count() * len(rules)
    by_name = {r.name: r for r in rules}

    def choose(group: pd.DataFrame) -> pd.DataFrame:  # at most one row per cutoff
        rule = by_name[group["rule"].iloc[0]]
        good, bad = np.zeros(len(rule.cutoffs) + 1, np.int64), np.zeros(len(rule.cutoffs) + 1, np.int64)
        good[group["level"]], bad[group["level"]] = group["good"], group["bad"]
        cutoff = certified(good, bad, rule.cutoffs, risk / len(rules), error / tests)
        none = cutoff is None
        return pd.DataFrame({
            "stratum": group["stratum"].iloc[:1], "rule": rule.name, "cutoff": 0 if none else cutoff,
            "good": good.sum(), "bad": bad.sum(), "tests": tests,
        }).iloc[: 0 if none else 1]

    schema = "stratum string, rule string, cutoff long, good long, bad long, tests long"
    return durable(counts.groupBy("stratum", "rule").applyInPandas(choose, schema))


def judged(rows: DataFrame, cutoffs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`rows` of `measured` with `failed` (names of failed rules by `cutoffs`) and kept.

    Rows that fail the base rules are not kept. Rows of strata without cutoffs are, else.
    """
    wide = cutoffs.groupBy("stratum").agg(
        *(F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}") for r in rules)
    )
    found = rows.join(small_side(durable(wide)), "stratum", "left")
    failed = F.array_compact(F.array(*(F.when(_over(r, F.col(f"cut_{r.name}")), F.lit(r.name)) for r in rules)))
    found = found.withColumn("failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop(*(f"cut_{r.name}" for r in rules))


def checked(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str = "lang",
            label: str = "quality") -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, failed.

    Words are runs without ASCII white space; null texts have none. A text of fewer than 20 words fails the base
    rules. Of equal rows each counts; null ids have no label. Other columns are not read, so their names do not
    matter. An empty table gives an empty result; without labels only the base rules reject.
    """
    rows = measured(docs, id=id, text=text, stratum=stratum)
    found = judged(rows, fit(rows, labels, id=id, label=label))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )
