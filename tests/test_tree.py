"""Search through a tree of cells: results, work, and what reaches the driver."""

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from test_neighbours import brute, clustered, frame, lists
from vecshelf.operators import neighbours, tree
from vecshelf.session import durable


def reps(spark, x):
    q = neighbours._keyed(frame(spark, range(len(x)), x), "id", "embedding")
    return durable(q.withColumn("copy", F.lit(1)))


def small_fanout(monkeypatch, fanout):
    monkeypatch.setattr(tree, "FANOUT", fanout)


@pytest.mark.parametrize("fanout,deepest", [(64, 2), (4, 6)])
def test_equal_to_brute_force_at_two_depths(spark, monkeypatch, fanout, deepest):
    small_fanout(monkeypatch, fanout)
    x = clustered(400, 5, 3, copies=60)
    found = neighbours.knn(frame(spark, range(400), x), k=7, block_rows=12, tree=True)
    assert lists(found) == brute(range(400), x, range(400), x, 7, "self")
    built = tree.build(reps(spark, clustered(400, 5, 3)), 5, 12)
    assert (len(built.levels) > 2) == (fanout == 4) and len(built.levels) <= deepest
    assert built.items.count() == 400 == built.leaves.agg(F.sum("n")).first()[0]


def test_other_queries_than_items(spark, monkeypatch):
    small_fanout(monkeypatch, 5)
    x, q = clustered(300, 4, 5), clustered(40, 4, 6) + 3
    found = neighbours.knn(frame(spark, range(40), q), frame(spark, range(300), x), k=6, drop=None, block_rows=15, tree=True)
    assert lists(found) == brute(range(40), q, range(300), x, 6, None)


def test_equal_through_joins_instead_of_broadcasts(spark, monkeypatch):
    small_fanout(monkeypatch, 6)
    x = clustered(250, 3, 9)
    monkeypatch.setattr(tree, "NUMBERED", 0)
    found = neighbours.knn(frame(spark, range(250), x), k=5, block_rows=20, tree=True)
    assert lists(found) == brute(range(250), x, range(250), x, 5, "self")


def test_near_equal_vectors_and_names_twice(spark, monkeypatch):
    """A leaf that no pivot can split is cut by hash; an id with two vectors is named once."""
    small_fanout(monkeypatch, 3)
    monkeypatch.setattr(tree, "DEPTH", 2)
    x = np.float32(np.vstack([np.ones((120, 3)), np.ones((120, 3)) + np.random.default_rng(1).normal(size=(120, 3)) * 1e-3]))
    ids = [i % 200 for i in range(240)]
    found, plain = (
        sorted(map(tuple, neighbours.knn(frame(spark, ids, x), k=4, **how).drop("d2").collect()))
        for how in ({"block_rows": 10, "tree": True}, {})
    )
    assert found == plain


def test_work_grows_slower_than_the_table(spark, monkeypatch):
    """On clustered vectors four times the items cost each query much less than four times the comparisons."""
    small_fanout(monkeypatch, 8)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 4)) * 20
    work = []
    for n in (500, 2_000):
        x = np.float32(centres[rng.integers(0, 40, n)] + rng.normal(size=(n, 4)))
        built = tree.build(reps(spark, x), 4, 16)
        kth = np.sort(((x[:100, None].astype(float) - x[None].astype(float)) ** 2).sum(-1), axis=1)[:, 10]
        asked = reps(spark, x[:100]).select("id", "k1", "k2", "vec").join(
            spark.createDataFrame([(i, float(d)) for i, d in enumerate(kth)], "id bigint, bound double"), "id").drop("id")
        work.append(tree.work(built, asked, 16) / 100)
    assert work[1] < 2 * work[0] and work[0] < 250


def test_no_level_is_collected(spark, monkeypatch):
    """The driver sees counts: no frame with more than one row is collected while the tree is built and searched."""
    small_fanout(monkeypatch, 4)
    sizes = []
    for name in ("collect", "toPandas", "toArrow"):
        real = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, real=real: sizes.append(self.limit(3).__class__.count(self)) or real(self))
    x = clustered(200, 3, 2)
    q = reps(spark, x)
    tree.search_tree(q, None, 4, 3, 10, False).write.format("noop").mode("overwrite").save()
    assert all(n <= 1 for n in sizes)
