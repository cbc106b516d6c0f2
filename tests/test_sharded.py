"""The head with its classes in shards against the one in a single matrix."""

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.operators import fit, head, sharded


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(90, 6)), rng.integers(0, 15, 90)
    x[:5] = x[0]
    w = rng.normal(size=(15, 6))
    w[7] = w[3]  # two classes tie
    rows = spark.createDataFrame([(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, y))],
                                 "id bigint, embedding array<double>, label bigint")
    weights = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(w)], "class bigint, w array<double>")
    return rows, weights, w


@pytest.mark.parametrize("shards", [1, 7])
def test_steps_equal_the_single_matrix(spark, data, monkeypatch, shards):
    rows, weights, w = data
    monkeypatch.setattr(sharded, "BLOCK_VALUES", 200)  # several blocks of rows
    state, plain = sharded.sharded_state(weights), fit.HeadState(w)
    for step in range(3):
        state, told = sharded.sharded_step(rows, state, step, 0.05, shards=shards)
        sums = fit.partial_sums(rows, plain.weights, "label", "embedding", 64.0, 0.4, False).orderBy("class").collect()
        a = np.array([r["sums"] for r in sums]) / sums[0]["n"]
        assert told["loss"] == pytest.approx(sum(r["loss"] for r in sums) / 90, rel=1e-9)
        assert told["accuracy"] == pytest.approx(sum(r["hits"] for r in sums) / 90)
        plain = fit.adamw(plain, fit.weight_slope(plain.weights, a), 0.05)
        found = {r["class"]: r for r in state.collect()}
        for name, matrix in (("w", plain.weights), ("first", plain.first), ("second", plain.second)):
            assert np.allclose([found[j][name] for j in range(15)], matrix, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("shards", [1, 7])
def test_evaluation_equals_the_single_matrix(data, shards):
    rows, weights, _ = data
    mine = sharded.sharded_evaluate(rows, sharded.sharded_state(weights), "id", batch_size=20, shards=shards).first()
    theirs = head.evaluate(rows, weights, "id", batch_size=20).first()
    assert set(mine.asDict()) == set(theirs.asDict())
    for name, value in theirs.asDict().items():
        assert mine[name] == pytest.approx(value, rel=1e-9), name


def test_edges(data):
    rows, weights, w = data
    state = sharded.sharded_state(weights)
    same, told = sharded.sharded_step(rows.limit(0), state, 0, 0.1)
    assert told["n"] == 0 and same.count() == 15
    with pytest.raises(ValueError, match="label"):
        sharded.sharded_step(rows.withColumn("label", F.lit(15)), state, 0, 0.1)
    with pytest.raises(ValueError, match="each once"):
        sharded.sharded_step(rows, sharded.sharded_state(weights.where("class <> 4")), 0, 0.1)


def test_the_driver_holds_no_matrix(data, monkeypatch):
    rows, weights, _ = data
    sizes = []
    for name in ("collect", "toPandas", "toArrow"):
        real = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, real=real: sizes.append(self.count()) or real(self))
    sharded.sharded_step(rows, sharded.sharded_state(weights), 0, 0.1, shards=4)
    assert all(n <= 1 for n in sizes)
