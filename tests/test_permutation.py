"""Shuffling by a permutation of positions: a bijection for any number of rows, well mixed, without an exchange."""

import pytest
from pyspark.sql import functions as F

from vecshelf.operators.batching import epoch_batches, laid_out, permuted


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 31, 64, 101, 1000])
def test_bijection(spark, n):
    rows = spark.range(n).select(*[permuted(F.col("id"), n, seed, epoch).alias(f"p{seed}{epoch}") for seed in (0, 9) for epoch in (0, 1)])
    columns = list(zip(*rows.collect()))
    assert all(sorted(c) == list(range(n)) for c in columns)
    if n > 30:
        assert len(set(columns)) == 4


def test_every_small_number(spark):
    """For all n up to 40 at once: positions of each n are permuted among themselves."""
    parts = [spark.range(n).select(F.lit(n).alias("n"), permuted(F.col("id"), n, 3, 2).alias("p")) for n in range(1, 41)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    found = whole.groupBy("n").agg(F.count_distinct("p").alias("k"), F.max("p").alias("top")).collect()
    assert all(r.k == r.n and r.top == r.n - 1 for r in found) and len(found) == 40


def test_well_mixed(spark):
    """Neighbours part, few rows stay, and any place is about as likely for the first row."""
    n = 2000
    found = [r.p for r in spark.range(n).select("id", permuted(F.col("id"), n, 1, 0).alias("p")).orderBy("id").collect()]
    assert sum(i == p for i, p in enumerate(found)) < 8
    near = sum(abs(a - b) < 20 for a, b in zip(found, found[1:]))
    assert near < 0.05 * n
    firsts = spark.range(1).select(*[permuted(F.lit(0), 10, seed, 0).alias(f"p{seed}") for seed in range(60)]).first()
    assert len(set(firsts)) >= 8


def test_no_exchange_in_an_epoch(spark):
    placed, n = laid_out(spark.range(500).withColumn("name", F.lit("x")), "id")
    epoch = epoch_batches(placed, n, 8, seed=2, epoch=5, world=4)
    assert "Exchange" not in epoch._jdf.queryExecution().executedPlan().toString()
    rows = epoch.collect()
    assert len(rows) == 500 and {r["rank"] for r in rows} == {0, 1, 2, 3}
    empty, none = laid_out(spark.range(0), "id")
    assert epoch_batches(empty, none, 8).collect() == []
