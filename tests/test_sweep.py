"""Chunks of queries against units of items: results over many units, and no copies of the queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_neighbours import brute, frame, lists
from vecshelf.operators import neighbours, sweep, tree
from vecshelf.session import durable


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(sweep, "UNIT_ROWS", (30, 30))
    monkeypatch.setattr(sweep, "CHUNK_ROWS", 20)


@pytest.mark.parametrize("deep", [False, True])
def test_vectors_without_structure_over_many_units(spark, small, deep):
    x = np.float32(np.random.default_rng(3).normal(size=(200, 12)))
    found = neighbours.knn(frame(spark, range(200), x), k=7, block_rows=9, tree=deep)
    assert lists(found) == brute(range(200), x, range(200), x, 7, "self")


def test_cells_are_grouped_up_to_a_unit():
    cells = neighbours._Cells(np.array([[0.0], [10.0], [1.0], [11.0], [2.0]]))
    assert cells.grouped({0: 5, 1: 9, 2: 5, 3: 1, 4: 50}, 10) == {0: 0, 2: 0, 4: 1, 1: 2, 3: 2}


def test_a_query_is_not_copied_for_each_leaf_that_it_calls(spark, small):
    x = np.float32(np.random.default_rng(5).normal(size=(150, 8)))
    rows = durable(neighbours._keyed(frame(spark, range(150), x), "id", "embedding").withColumn("copy", F.lit(1)))
    built = tree.build(rows, 8, 6)
    levels = tree.bundles(built, 30)
    asked = durable(rows.select("k1", "k2", "vec", F.lit(None).cast("double").alias("bound")))
    assert tree.visits(built, asked, 30).count() > 20 * 150
    called = tree.calls(levels, asked, 30)
    assert called.count() == 150 and called.agg(F.max(F.size("calls"))).first()[0] <= 11
    bundled = tree.bundle_of(built, levels)
    assert bundled.count() == bundled.select("leaf").distinct().count() == built.leaves.count()
