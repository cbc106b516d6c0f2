"""Search against brute force, with ties, copies, blocks and short tables."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vecshelf.operators import lookup, neighbours
from vecshelf.operators.compare import overlap
from vecshelf.operators.lists import format_lists, neighbour_lists

SCHEMA = "id bigint, embedding array<float>"


def frame(spark, ids, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], SCHEMA)


def brute(q_ids, q, x_ids, x, k, drop):
    q, x = np.float32(q).astype(float), np.float32(x).astype(float)
    out = {}
    for i, row in zip(q_ids, q):
        d2 = ((x - row) ** 2).sum(axis=1)
        order = sorted(range(len(x)), key=lambda j: (round(d2[j], 9), x_ids[j]))
        found = [x_ids[j] for j in order]
        if drop == "self":
            found = [j for j in found if j != i]
        elif drop == "first":
            found = found[1:]
        out[i] = found[:k]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("id", "rank").collect():
        out.setdefault(r["id"], []).append(r["neighbour_id"])
    return out


def clustered(n, dim, seed, copies=0):
    """Points in tight groups, some of them many times over."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim)) * 10
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.3
    if copies:
        x[:copies] = x[0]
    return np.float32(x)


@pytest.mark.parametrize("drop", ["self", "first", None])
@pytest.mark.parametrize("rows", [None, 25])
def test_against_brute_force(spark, drop, rows):
    x = clustered(150, 5, 1, copies=50)
    ids = [int(i) for i in np.random.default_rng(2).permutation(1000)[:150]]
    found = neighbours.knn(frame(spark, ids, x), k=7, drop=drop, block_rows=rows)
    assert lists(found) == brute(ids, x, ids, x, 7, drop)


@pytest.mark.parametrize("rows", [None, 20, 60])
def test_queries_and_items_apart(spark, rows):
    x, q = clustered(130, 4, 3, copies=30), clustered(70, 4, 4, copies=25)
    q[:10] = x[40:50]
    items, queries = frame(spark, range(130), x), frame(spark, range(500, 570), q)
    found = neighbours.knn(queries, items, k=5, drop=None, block_rows=rows)
    assert lists(found) == brute(list(range(500, 570)), q, list(range(130)), x, 5, None)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.integers(3, 40), st.integers(1, 9), st.booleans())
def test_blocks_do_not_matter(spark, seed, rows, k, grid):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 3, (90, 3)) if grid else rng.normal(size=(90, 3))
    x = np.float32(x)
    df = frame(spark, range(90), x)
    expected = brute(list(range(90)), x, list(range(90)), x, k, "self")
    assert lists(neighbours.knn(df, k=k, block_rows=rows)) == expected


def test_pivots_close_together_and_far_from_the_origin(spark):
    """Rounding in the bounds must not hide anything."""
    rng = np.random.default_rng(8)
    x = np.float32(1000 + np.repeat(rng.normal(size=(12, 3)) * 0.05, 10, axis=0) + rng.normal(size=(120, 3)) * 1e-3)
    ids = list(range(120))
    found = neighbours.knn(frame(spark, ids, x), k=6, block_rows=12)
    assert lists(found) == brute(ids, x, ids, x, 6, "self")


def test_far_cells_are_left_out(spark):
    """In grouped data the second pass visits few blocks."""
    centres = np.arange(20)[:, None] * np.array([[100.0, 0.0]])
    rng = np.random.default_rng(5)
    x = np.float32(np.repeat(centres, 20, axis=0) + rng.normal(size=(400, 2)))
    cells = neighbours._Cells(x[::20].astype(float))
    df = frame(spark, range(400), x).withColumn("_at", cells.nearest()(F.col("embedding")))
    at = df.select("id", "embedding", "_at.*").orderBy("id").collect()
    far = np.zeros(20)
    for r in at:
        far[r["cell"]] = max(far[r["cell"]], r["dist"])
    reach = cells.within(np.zeros(20), far, 3)
    found = F.array(*[F.lit(v) for v in (0.0, 4.0, 9.0)])
    routed = df.select(reach(F.col("embedding"), F.col("_at.cell"), found).alias("c")).collect()
    assert all(len(r["c"]) == 1 for r in routed)
    # With fewer distances than wanted, everything must be visited.
    short = F.array(F.lit(0.0))
    routed = df.select(reach(F.col("embedding"), F.col("_at.cell"), short).alias("c")).collect()
    assert all(len(r["c"]) == 20 for r in routed)


def test_identical_vectors(spark):
    df = frame(spark, [3, 1, 2], np.ones((3, 2)))
    assert lists(neighbours.knn(df)) == {1: [2, 3], 2: [1, 3], 3: [1, 2]}
    assert lists(neighbours.knn(df, drop="first")) == {1: [2, 3], 2: [2, 3], 3: [2, 3]}


def test_few_rows_and_none(spark):
    df = frame(spark, [1, 2, 3], [[0.0], [1.0], [3.0]])
    assert lists(neighbours.knn(df, k=12)) == {1: [2, 3], 2: [1, 3], 3: [2, 1]}
    assert neighbours.knn(df.where("id = 1")).count() == 0
    assert neighbours.knn(df.where("false")).count() == 0
    assert neighbours.knn(df, df.where("false")).count() == 0
    assert neighbours.knn(df.where("false"), df).count() == 0


def test_one_id_with_two_names_never_lists_itself(spark):
    df = spark.createDataFrame([(1, [0.0]), (1, [0.5]), (2, [1.0])], SCHEMA)
    found = neighbours.knn(df, k=2).collect()
    assert all(r["id"] != r["neighbour_id"] for r in found)


def test_text_ids_and_zero_signs(spark):
    df = spark.createDataFrame([("b", [0.0]), ("a", [-0.0]), ("c", [2.0])], "id string, embedding array<double>")
    rows = neighbours.knn(df, k=1).orderBy("id").collect()
    assert [(r["id"], r["neighbour_id"], r["d2"]) for r in rows] == [("a", "b", 0.0), ("b", "a", 0.0), ("c", "a", 4.0)]


def test_distances_are_exact_for_near_twins(spark):
    base = np.full((4, 8), 1000.0)
    base[1, 0] += 1 / 1024
    base[2, 0] += 2 / 1024
    base[3, 0] -= 3 / 1024
    rows = neighbours.knn(frame(spark, range(4), base), k=3).where("id = 0").orderBy("rank").collect()
    assert [r["neighbour_id"] for r in rows] == [1, 2, 3]
    assert rows[0]["d2"] == 1 / 1024**2


def test_bad_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA)
    with pytest.raises(ValueError):
        neighbours.knn(df)
    with pytest.raises(ValueError):
        neighbours.knn(df.where("id = 1"), df.where("id = 2"))
    with pytest.raises(ValueError):
        neighbours.knn(df.where("id = 1"), drop="last")
    holes = spark.createDataFrame([(1, [1.0, None]), (2, [1.0, 2.0])], SCHEMA)
    with pytest.raises(PySparkException, match="null value"):
        neighbours.knn(holes).collect()
    endless = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0, 2.0])], SCHEMA)
    with pytest.raises(PySparkException, match="finite"):
        neighbours.knn(endless).collect()


def test_lists_as_text(spark):
    df = spark.createDataFrame([(1, ",x", 1), (1, "a,b", 3), (1, "c", 2), (2, "z,", 1)], "id int, neighbour_id string, rank int")
    assert {tuple(r) for r in neighbour_lists(df).collect()} == {(1, "x,c,a,b"), (2, "z")}
    x = frame(spark, range(9), np.arange(9)[:, None] ** 2.0)
    by_rows = {tuple(r) for r in neighbour_lists(neighbours.knn(x, k=3)).collect()}
    assert by_rows == {tuple(r) for r in format_lists(neighbours.knn_lists(x, k=3)).collect()}


def test_overlap(spark):
    schema = "id int, neighbour_id int, rank int"
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 5, 1), (3, 7, 1)], schema)
    b = spark.createDataFrame([(1, 10, 1), (1, 12, 2), (1, 13, 3), (2, 5, 1), (2, 6, 2)], schema)
    rows = {r["id"]: tuple(r)[1:] for r in overlap(a, b, 3).collect()}
    assert rows == {1: (2, 2 / 3, 0.5, 2), 2: (1, 1 / 3, 0.5, 2)}
    assert overlap(a, a, 3).where("first_diff is not null").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_split_and_complete(spark, how):
    rows = [(i, "hot" if i % 3 else f"k{i % 30}") for i in range(300)] + [(i, None) for i in range(300, 340)]
    left = spark.createDataFrame(rows, "id int, key string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k9", 3), ("other", 4)], "key string, v int")
    found = lookup.lookup_join(left, right, "key", spread=["id"], how=how, hot_rows=20)
    expected = left.join(right, "key", how)
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_hot_keys_spread_over_tasks(spark):
    left = spark.range(20_000).select("id", F.lit("hot").alias("key"))
    right = spark.createDataFrame([("hot", 1)], "key string, v int")
    settings_ = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    try:
        found = lookup.lookup_join(left, right, "key", spread=["id"], hot_rows=500)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000
    assert max(sizes) < 8_000


def test_kernel_against_brute_force(monkeypatch):
    """Grids with many ties, wide and narrow ranges, far from the origin, in slices of any size."""
    rng = np.random.default_rng(0)
    for trial in range(120):
        n, dim, m, k = (int(rng.integers(1, top)) for top in (900, 9, 40, 14))
        if trial % 3 == 0:
            x = rng.integers(0, 4, (n, dim)).astype(float)
        else:
            x = rng.normal(size=(n, dim)) * 10.0 ** rng.integers(-30, 30) + (1000 if trial % 3 == 1 else 0)
        q = x[rng.integers(0, n, m)] + (rng.normal(size=(m, dim)) if trial % 2 else 0)
        monkeypatch.setattr(neighbours, "SLICE_VALUES", int(rng.integers(1, 5000)))
        sizes, _, places = neighbours.nearest_in_block(q, x, k)
        assert sizes.tolist() == [min(k, n)] * m
        for row, found in zip(q, np.split(places, np.cumsum(sizes)[:-1])):
            diff = row - x
            d2 = neighbours.tie_key(np.einsum("ij,ij->i", diff, diff))
            assert found.tolist() == np.lexsort((np.arange(n), d2))[:k].tolist()
