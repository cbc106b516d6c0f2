"""Exact nearest neighbours through a tree of balls, for tables with more cells than a driver should hold.

Each level splits the nodes that are still too large by pivots of their own, and keeps for every child
how near and how far its items lie from its pivot. Queries go down level by level: once to the leaf of
their nearest pivots, whose search bounds the answer, and once to every child that may hold something
within that bound. They stop at children of a unit's size (see `operators.sweep`), which are bundled, and
name the bundles to be searched. A level is a table; the driver sees row counts only.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.functions.vectors import to_matrix
from vecshelf.operators.lookup import lookup_join
from vecshelf.operators.sweep import sweep, unit_rows
from vecshelf.session import durable

FANOUT = 256  # children of a node, at most
PIVOT_VALUES = 2 * 1024 * 1024  # numbers in a node's pivots, which one task holds
PIVOTS_PER_LEAF = 4
DEPTH = 6  # levels; a leaf that is still large is cut into blocks by hash
NUMBERED = 1_000_000  # nodes whose numbers may be broadcast, at some 16 bytes each
GROUPS_PER_TASK = 8
SLICE_VALUES = 1024 * 1024
TIE_ROOM = 2.0**-28  # bounds may be off by a tie


class Tree(NamedTuple):
    """`levels`: (node, child, pivot, near, far, n, open) each; `items`: (id, k1, k2, vec, copy, leaf); `leaves`: (leaf, n)."""

    levels: list[DataFrame]
    items: DataFrame
    leaves: DataFrame
    fanout: int = FANOUT


def build(reps: DataFrame, dim: int, leaf_rows: int, fanout: int | None = None, room: str | None = None) -> Tree:
    """Split `reps` (id, k1, k2, vec, copy; written) until leaves hold at most `leaf_rows` items.

    Pivots are the first vectors of a node in the order of their hashes, so every run makes the same tree.
    Copies of one vector stay together. `room` names a column of distances by which each item widens its balls.
    """
    own = F.col(room) if room else F.lit(0.0)
    fanout = fanout or max(2, min(FANOUT, PIVOT_VALUES // max(dim, 1)))
    levels, done = [], []
    rows, sizes = reps.withColumn("node", F.lit(0).cast("long")), None
    for depth in range(DEPTH):
        if sizes is None:
            sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        pivots = durable(_pivots(rows, sizes, fanout, leaf_rows))
        placed = durable(_assigned(rows, sizes, pivots, leaf_rows))
        found = placed.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("copy") == 1).alias("n_unique"),
            F.min(F.col("dist") - own).alias("near"), F.max(F.col("dist") + own).alias("far"),
        )
        more = (F.col("n") > leaf_rows) & (F.col("n_unique") > 1) & F.lit(depth + 1 < DEPTH)
        level = durable(
            pivots.join(found.withColumnRenamed("node", "child"), "child")
            .select("node", "child", "pivot", "near", "far", "n", more.alias("open"))
        )
        levels.append(level)
        numbered = _numbered(placed.drop("dist"), level.select(F.col("child").alias("node"), "open"))
        done.append(numbered.where("not open").drop("open"))
        if level.where("open").isEmpty():
            break
        rows = durable(numbered.where("open").drop("open"))
        sizes = level.where("open").select(F.col("child").alias("node"), "n")
    items = done[0]
    for part in done[1:]:
        items = items.unionByName(part)
    leaves = levels[0].where("not open").select(F.col("child").alias("leaf"), "n")
    for level in levels[1:]:
        leaves = leaves.unionByName(level.where("not open").select(F.col("child").alias("leaf"), "n"))
    return Tree(levels, items.withColumnRenamed("node", "leaf"), leaves, fanout)


def _pivots(rows: DataFrame, sizes: DataFrame, fanout: int, leaf_rows: int) -> DataFrame:
    """Up to `fanout` different vectors of each node: node, child, pivot. Tasks cut to that many before the shuffle.

    A node gets no more than PIVOTS_PER_LEAF for each leaf that its items would fill, so that leaves hold several.
    """
    place = F.row_number().over(W.partitionBy("node").orderBy("k1", "k2"))
    drawn = rows.where("copy = 1").withColumn("place", place).where(F.col("place") <= fanout)
    most = F.greatest(F.lit(2), F.ceil(F.col("n") * PIVOTS_PER_LEAF / leaf_rows))
    drawn = _numbered(drawn, sizes.select("node", "n")).where(F.col("place") <= most)
    return drawn.select("node", (F.col("node") * fanout + F.col("place")).alias("child"), F.col("vec").alias("pivot"))


def _numbered(rows: DataFrame, numbers: DataFrame, key: str = "node") -> DataFrame:
    """Add to each row what a (written) table tells of its node; a hot node is split where it must be joined."""
    if numbers.count() <= NUMBERED:
        return rows.join(F.broadcast(numbers), key)
    return lookup_join(rows, numbers, key, spread=["k1"])


def _chunked(rows: DataFrame, sizes: DataFrame, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a chunk, about `chunk_rows` of a node together, and the number of chunks of each node."""
    chunks = durable(sizes.select("node", F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks")))
    cut = _numbered(rows, chunks).withColumn("chunk", F.pmod("k1", F.col("chunks")).cast("int")).drop("chunks")
    return cut, chunks


def _beside(rows: DataFrame, sizes: DataFrame, children: DataFrame, chunk_rows: int, run, schema: T.StructType) -> DataFrame:
    """`run` on each chunk of a node's rows and the node's children."""
    cut, chunks = _chunked(rows, sizes, chunk_rows)
    copies = children.join(chunks, "node").select(
        *[F.col(c).alias(f"to_{c}") for c in children.columns],
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("to_chunk"),
    )
    # Groups are whole chunks, and much work though small in bytes: their number sets that of the tasks.
    spark = rows.sparkSession
    groups = chunks.agg(F.sum("chunks")).first()[0] or 1
    least = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = int(min(groups, max(least, groups // GROUPS_PER_TASK)))
    return (
        cut.repartition(tasks, "node", "chunk").groupBy("node", "chunk")
        .cogroup(copies.repartition(tasks, "to_node", "to_chunk").groupBy("to_node", "to_chunk"))
        .applyInArrow(run, schema)
    )


def _distances(x: np.ndarray, p: np.ndarray):
    pp = np.einsum("ij,ij->i", p, p)
    step = max(SLICE_VALUES // max(len(p), 1), 1)
    for start in range(0, len(x), step):
        part = x[start : start + step]
        d2 = np.einsum("ij,ij->i", part, part)[:, None] + pp[None, :] - 2.0 * (part @ p.T)
        yield slice(start, start + step), np.sqrt(np.maximum(d2, 0.0))


def _assigned(rows: DataFrame, sizes: DataFrame, children: DataFrame, chunk_rows: int) -> DataFrame:
    """Rows moved to the child of their node whose pivot is nearest, with the distance to it."""
    kept = [c for c in rows.columns if c != "node"]
    schema = T.StructType([
        *[rows.schema[c] for c in kept], T.StructField("node", T.LongType()), T.StructField("dist", T.DoubleType()),
    ])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], left.schema.field(n).type) for n in kept} | {
                "node": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())})
        right = right.sort_by("to_child")
        x, p = to_matrix(left.column("vec")), to_matrix(right.column("to_pivot"))
        child, dist = np.zeros(len(x), np.int64), np.zeros(len(x))
        ids = right.column("to_child").to_numpy()
        for part, d in _distances(x, p):
            child[part], dist[part] = ids[d.argmin(axis=1)], d.min(axis=1)
        return left.select(kept).append_column("node", pa.array(child)).append_column("dist", pa.array(dist))

    return _beside(rows, sizes, children.select("node", "child", "pivot"), chunk_rows, run, schema)


def homes(tree: Tree, asked: DataFrame, chunk_rows: int) -> DataFrame:
    """Queries (k1, k2, vec) with the leaf that their nearest pivots lead to."""
    rows, done = asked.withColumn("node", F.lit(0).cast("long")), []
    for level in tree.levels:
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        moved = durable(_assigned(rows, sizes, level, chunk_rows).drop("dist"))
        moved = _numbered(moved, level.select(F.col("child").alias("node"), "open"))
        done.append(moved.where("not open").drop("open"))
        rows = moved.where("open").drop("open")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.withColumnRenamed("node", "leaf")


def _within(left: pa.Table, right: pa.Table):
    """Slices of the queries, and which children may hold something within each one's bound.

    Lower bounds on the distance to anything in a child: beyond its outer radius, and inside its inner one. A
    slack covers rounding, so that ties at the bound are still visited.
    """
    x, p = to_matrix(left.column("vec")), to_matrix(right.column("to_pivot"))
    near, far = right.column("to_near").to_numpy(), right.column("to_far").to_numpy()
    bound = np.sqrt(pc.fill_null(left.column("bound"), np.inf).to_numpy() * (1 + TIE_ROOM))
    scale = np.sqrt(np.einsum("ij,ij->i", x, x)) + np.sqrt(np.einsum("ij,ij->i", p, p)).max() + far[np.isfinite(far)].max(initial=0.0)
    for part, d in _distances(x, p):
        low = np.maximum(d - far[None, :], near[None, :] - d)
        yield part, low <= (bound[part] + 1e-6 * scale[part])[:, None]


def visits(tree: Tree, asked: DataFrame, chunk_rows: int) -> DataFrame:
    """The leaves that may hold something within each query's `bound` (null: anything): columns of `asked` and leaf."""
    kept = asked.columns
    schema = T.StructType([*[asked.schema[c] for c in kept], T.StructField("node", T.LongType()), T.StructField("open", T.BooleanType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], left.schema.field(n).type) for n in kept} | {
                "node": pa.array([], pa.int64()), "open": pa.array([], pa.bool_())})
        rows, places = [], []
        for part, near in _within(left, right):
            row, place = np.nonzero(near)
            rows.append(row + part.start)
            places.append(place)
        row, place = pa.array(np.concatenate(rows)), pa.array(np.concatenate(places))
        found = left.select(kept).take(row)
        return found.append_column("node", right.column("to_child").take(place)).append_column(
            "open", right.column("to_open").take(place))

    rows, done = asked.withColumn("node", F.lit(0).cast("long")), []
    for level in tree.levels:
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        called = durable(_beside(rows, sizes, level.drop("n"), chunk_rows, run, schema))
        done.append(called.where("not open").drop("open"))
        rows = called.where("open").drop("open")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.withColumnRenamed("node", "leaf")


def bundles(tree: Tree, rows: int) -> list[DataFrame]:
    """The levels down to children of at most `rows` items, with a `bundle`: siblings of about that many items together.

    A bundle is named by its first child. Larger children have none, unless they are leaves.
    """
    levels, siblings = [], W.partitionBy("node").orderBy("child")
    for depth, level in enumerate(tree.levels):
        if depth:
            above = levels[-1].where("bundle is null").select(F.col("child").alias("node"))
            level = level.join(above, "node", "left_semi")
        whole = (F.col("n") <= rows) | ~F.col("open")
        before = F.sum(F.when(whole, F.col("n"))).over(siblings) - F.col("n")
        placed = level.withColumn("_place", F.when(whole, F.floor(before / rows)))
        first = F.min("child").over(W.partitionBy("node", "_place"))
        levels.append(durable(placed.withColumn("bundle", F.when(whole, first)).drop("_place")))
        if levels[-1].where("bundle is null").isEmpty():
            break
    return levels


def bundle_of(tree: Tree, levels: list[DataFrame]) -> DataFrame:
    """(leaf, bundle): a leaf's children are numbered so that its number tells all nodes above it."""
    up, above = F.col("leaf"), [F.col("leaf")]
    for _ in tree.levels[1:]:
        up = ((up - 1 - F.pmod(up - 1, F.lit(tree.fanout))) / tree.fanout).cast("long")
        above.append(up)
    named = levels[0].where("bundle is not null").select("child", "bundle")
    for level in levels[1:]:
        named = named.unionByName(level.where("bundle is not null").select("child", "bundle"))
    leaves = tree.leaves.select("leaf", F.explode(F.array(*above)).alias("child"))
    return leaves.join(named, "child").select("leaf", "bundle")


def calls(levels: list[DataFrame], asked: DataFrame, chunk_rows: int) -> DataFrame:
    """`asked` (with k1, vec, bound) and `calls`, the bundles that may hold something within the bound (null: anything).

    One row per query and node with bundles that it visits; no query is copied for each bundle.
    """
    kept = asked.columns
    schema = T.StructType([
        *[asked.schema[c] for c in kept], T.StructField("calls", T.ArrayType(T.LongType())), T.StructField("more", T.ArrayType(T.LongType())),
    ])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = left.select(kept).slice(0, 0)
            return none.append_column("calls", pa.array([], pa.list_(pa.int64()))).append_column("more", pa.array([], pa.list_(pa.int64())))
        right = right.sort_by([("to_bundle", "ascending"), ("to_child", "ascending")])
        child = right.column("to_child").to_numpy()
        whole = pc.is_valid(right.column("to_bundle")).to_numpy()
        names, starts = np.unique(pc.fill_null(right.column("to_bundle"), -1).to_numpy()[whole], return_index=True)
        found: tuple[list, list] = ([], [])
        for part, near in _within(left, right):
            called = np.logical_or.reduceat(near[:, : whole.sum()], starts, axis=1) if len(names) else near[:, :0]
            found[0].append(_named(called, names))
            found[1].append(_named(near[:, whole.sum() :], child[~whole]))
        return (
            left.select(kept).append_column("calls", pa.chunked_array(found[0], pa.list_(pa.int64())))
            .append_column("more", pa.chunked_array(found[1], pa.list_(pa.int64())))
        )

    rows, done = asked.withColumn("node", F.lit(0).cast("long")), []
    for depth, level in enumerate(levels):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        called = durable(_beside(rows, sizes, level.drop("n", "open"), chunk_rows, run, schema))
        done.append(called.where(F.size("calls") > 0).drop("more"))
        rows = called.where(F.size("more") > 0).drop("calls").withColumn("node", F.explode("more")).drop("more")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found


def _named(open_: np.ndarray, names: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(open_.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(names[np.nonzero(open_)[1]], pa.int64()))


def search_tree(
    reps: DataFrame, q: DataFrame | None, want: int, dim: int, rows: int, repeated: bool, fanout: int | None = None
) -> DataFrame:
    """Lists (k1, k2, list) of each different query vector; the two passes of `neighbours`, over a tree."""
    from vecshelf.operators import neighbours as N

    reps = durable(reps)
    tree = build(reps, dim, rows, fanout)
    leaves = durable(tree.leaves.select("leaf", F.ceil(F.col("n") / rows).cast("int").alias("subs")))
    items = durable(tree.items)
    stock = _subbed(items.select("id", "k1", "k2", "vec", "leaf"), leaves)
    asked = (
        items.where("copy = 1").select("k1", "k2", "vec", "leaf") if q is None else homes(tree, N._unique(q), rows)
    )
    home = durable(_subbed(asked, leaves).withColumn("bound", F.lit(None).cast("double")))
    first = _searched(home, stock, want, rows, repeated, keep_vec=True)
    bound = F.when(F.size("list") >= want, F.element_at("list.d2", -1))
    size = unit_rows(dim)
    levels = bundles(tree, size)
    bundled = durable(bundle_of(tree, levels).withColumnRenamed("bundle", "home"))
    routed = durable(_numbered(first.select("k1", "k2", "vec", F.col("cell").alias("leaf"), bound.alias("bound")), bundled, "leaf").drop("leaf"))
    called = durable(calls(levels, routed, size).withColumnRenamed("home", "node"))
    held = durable(_numbered(items.select("id", "k1", "vec", "leaf"), bundled, "leaf").select("id", "k1", "vec", F.col("home").alias("node")))
    return N._merge(sweep(called, held, want, dim, repeated), want, repeated)


def _subbed(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    return _numbered(rows, leaves, "leaf").withColumn("sub", F.pmod("k2", F.col("subs")).cast("int")).drop("subs")


def _searched(asked: DataFrame, stock: DataFrame, want: int, rows: int, repeated: bool, keep_vec: bool = False) -> DataFrame:
    """Chunks of the queries that call a block beside that block; blocks that none calls are not sent."""
    from vecshelf.operators import neighbours as N

    calls = durable(
        asked.groupBy("leaf", "sub").count()
        .select("leaf", "sub", F.ceil(F.col("count") / rows).cast("int").alias("chunks"))
    )
    groups = calls.agg(F.sum("chunks")).first()[0] or 1
    chunk = F.pmod("k1", F.col("chunks")).cast("int")
    key = ["leaf", "sub"]
    few = calls.count() <= NUMBERED

    def told(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(calls), key) if few else lookup_join(df, calls, key, spread=["k1"])

    queries = told(asked).select("k1", "k2", "vec", F.col("leaf").alias("cell"), "sub", chunk.alias("chunk"), "bound")
    copies = told(stock).select(
        "id", "vec", F.col("leaf").alias("cell"), "sub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    return N._search(queries, copies, want, int(groups), repeated, keep_vec)


def work(tree: Tree, asked: DataFrame, chunk_rows: int) -> int:
    """How many items the queries (k1, k2, vec, bound) would be compared with: a measure of the tree."""
    found = _numbered(visits(tree, asked, chunk_rows), durable(tree.leaves), "leaf")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
