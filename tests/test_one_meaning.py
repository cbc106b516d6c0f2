"""The same answer whatever the size of a table, the scale of vectors, or gaps and repeats in ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecshelf.operators import clean, neighbours
from vecshelf.operators.compare import arm_metrics, purity
from vecshelf.operators.counts import RunCounts
from vecshelf.operators.embed import sentence_vectors
from vecshelf.operators.encode import encode
from vecshelf.operators.fit import ArcHead, HeadState
from vecshelf.sinks import records as R
from vecshelf.sources.catalogue import named


@pytest.mark.parametrize("scale", [1e-30, 1e-6, 1.0, 1e19, 1e60])
@pytest.mark.parametrize("block", [None, 40])
def test_neighbours_at_any_scale(spark, scale, block):
    x = np.random.default_rng(3).normal(size=(200, 8)) * scale
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    found = {r["id"]: [n["neighbour_id"] for n in r["neighbours"]] for r in neighbours.knn_lists(df, block_rows=block).collect()}
    for i in range(200):
        d = ((x - x[i]) ** 2).sum(axis=1) / scale / scale
        d[i] = np.inf
        assert found[i] == np.argsort(d, kind="stable")[:12].tolist()


def test_too_large_vectors_are_refused():
    with pytest.raises(ValueError):
        neighbours.nearest_in_block(np.full((1, 2), 1e200), np.zeros((3, 2)), 2)


@pytest.mark.parametrize("block", [None, 30])
@pytest.mark.parametrize("names", [5, 60])
def test_lists_are_full_when_ids_repeat(spark, block, names):
    rng = np.random.default_rng(4)
    rows = [(i % 30, rng.integers(0, 4, 3).astype(float).tolist()) for i in range(150)]
    rows += [(99, rng.normal(size=3).tolist()) for _ in range(names)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    found = sorted((r["id"], [(n["d2"], n["neighbour_id"]) for n in r["neighbours"]]) for r in neighbours.knn_lists(df, k=9, block_rows=block).collect())
    want = []
    for own, v in rows:
        best = {}
        for other, w in rows:
            if other != own:
                best[other] = min(best.get(other, np.inf), float(((np.array(v) - np.array(w)) ** 2).sum()))
        want.append((own, sorted((d, o) for o, d in best.items())[:9]))
    assert [(i, [n for _, n in l]) for i, l in found] == [(i, [n for _, n in l]) for i, l in sorted(want)]


def test_labels_of_any_length(spark):
    rows = [("a", "9223372036854775807"), ("b", "0000000000000000000001"), ("c", "9223372036854775808"), ("d", "x"), ("e", " 1 ")]
    df = spark.createDataFrame(rows, "query string, label string")
    parsed = {r["query"]: r["label"] for r in clean.parse_label(df).collect()}
    assert parsed == {"a": 2**63 - 1, "b": 1, "c": None, "d": None, "e": 1}
    good, rejects = clean.checked_labels(df, n_classes=2)
    assert {r["query"] for r in good.collect()} == {"b", "e"}
    assert {(r["id"], r["text"], r["reason"]) for r in rejects.collect()} == {
        ("a", "9223372036854775807", "label"), ("c", "9223372036854775808", "label"), ("d", "x", "label"),
    }


@pytest.mark.parametrize("inline", [0, 100])
def test_null_is_no_stopword(spark, inline):
    df = spark.createDataFrame([(1, ["a", "b", "a"])], "id int, tokens array<string>")
    stop = spark.createDataFrame([("b",), (None,), ("b",)], "stopword string")
    assert clean.drop_stopwords(df, "id", "tokens", stop, inline).first()["tokens"] == ["a", "a"]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_repeated_tokens_and_missing_ids(spark, limit):
    df = spark.createDataFrame([(None, ["a", "b"]), (1, ["b"]), (1, ["a"])], "id int, tokens array<string>")
    words = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("b", [5.0, 0.0]), (None, [9.0, 9.0])], "token string, vec array<double>"
    )
    rows = sentence_vectors(df, "id", "tokens", words, 2, broadcast_bytes=limit).collect()
    assert sorted((r["id"] or 0, r["embedding"]) for r in rows) == [(0, [0.5, 0.5]), (1, [0.0, 1.0]), (1, [1.0, 0.0])]
    vocab = spark.createDataFrame([("a", 4), ("b", 6), ("b", 5), (None, 7)], "token string, id long")
    coded = encode(df, "id", "tokens", vocab, broadcast_bytes=limit).collect()
    assert sorted((r["id"] or 0, r["input_ids"]) for r in coded) == [(0, [2, 4, 5, 3]), (1, [2, 4, 3]), (1, [2, 5, 3])]


def test_missing_ids_are_rejected(spark):
    good, rejects = named(spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "id int, name string"))
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["reason"] for r in rejects.collect()} == {"null_id", "null_name"}


def test_publish_computes_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        calls.add(1)
        return x

    lists = spark.range(50).select("id", F.lit("1,2").alias("value")).withColumn("value", counted("value"))
    made = R.publish(lists, None, F.current_timestamp(), path=str(tmp_path / "p"), writer=lambda: (lambda rows: None))
    stored = {(r["key"], r["written_at"]) for r in spark.read.parquet(str(tmp_path / "p")).collect()}
    assert stored == {(r["key"], r["written_at"]) for r in made.collect()}
    assert calls.value == 50


def test_counts_without_a_job(spark):
    counts = RunCounts(wait_s=0.5)
    counts.watch("never", spark.range(3))
    with pytest.raises(RuntimeError, match="never"):
        counts.counts()


def test_missing_users_do_not_count(spark):
    events = spark.createDataFrame([(None, "view", 1.0), (None, "view", 3.0)], "user_id long, event_type string, value double")
    assert [(r["events"], r["users"]) for r in arm_metrics(events, arms=1).collect()] == [(2, 0)]


def test_purity(spark):
    lists = spark.createDataFrame([(1, 2, 1), (1, 3, 2), (2, 9, 1), (3, 1, 1)], "id int, neighbour_id int, rank int")
    labels = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (9, None)], "id int, label string")
    assert {r["id"]: r["purity"] for r in purity(lists, labels).collect()} == {1: 0.5, 2: 0.0, 3: 0.0}


def test_resumed_state_must_fit():
    with pytest.raises(ValueError, match="saved weights"):
        ArcHead(n_classes=3, dim=2)._start(None, HeadState(np.zeros((2, 2))))
