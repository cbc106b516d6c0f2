"""Token lookups: results, collisions, and one index per worker."""

import os
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from vecshelf.operators import index
from vecshelf.operators.embed import WordVectors


def made(words):
    return index.TokenIndex(pa.table({"token": pa.array(words, pa.string())}))


def test_find():
    words = ["b", "a", "", "é", "long " * 50]
    asked = pa.array(["a", None, "x", "b", "", "é", "a", "long " * 50, "long"])
    assert made(words).find(asked).tolist() == [1, -1, -1, 0, 2, 3, 1, 4, -1]
    assert made(words).find(pa.array([], pa.string())).tolist() == []
    assert made([]).find(asked).tolist() == [-1] * 9


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(index, "_hashes", lambda tokens: np.array([len(t) for t in tokens.to_pylist()], np.uint64))
    words = ["aa", "bb", "c", "dd"]
    assert made(words).find(pa.array(["dd", "aa", "ee", "c", "d", "bb"])).tolist() == [3, 0, -1, 2, -1, 1]


def test_derived_parts_are_made_once_and_never_sent():
    words = WordVectors(pa.table({"token": ["a", "b"], "vec": [[3.0, 4.0], [0.0, 0.0]]}), 2, "unsupervised")
    assert words.matrix is words.matrix and words._sorted is words._sorted
    assert words.matrix.tolist() == [[0.6, 0.8], [0.0, 0.0]] and words.counts.tolist() == [True, False]
    again = pickle.loads(pickle.dumps(words))
    assert set(again.__dict__) == {"table", "dim", "mode"} and again.find(pa.array(["b"])).tolist() == [1]


def test_one_index_per_worker(spark):
    sent = spark.sparkContext.broadcast(WordVectors(pa.table({"token": ["a", "b"], "vec": [[1.0], [2.0]]}), 1, "supervised"))

    @F.arrow_udf("string")
    def which(v: pa.Array) -> pa.Array:
        words = sent.value
        new = "_sorted" not in words.__dict__
        words.find(pa.array(["a"]))
        return pa.array([f"{os.getpid()} {new}"] * len(v))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        seen = [r[0].split() for r in spark.range(0, 2000, 1, 16).select(which("id")).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    built = {pid for pid, new in seen if new == "True"}
    first = sum(new == "True" for _, new in seen) / 10  # batches of ten rows
    assert first <= len({pid for pid, _ in seen}) and len(built) <= len({pid for pid, _ in seen})
