"""Chunks of queries against units of items, without a copy of either on disk.

Queries and items are packed, each vector once, into rows of some thousand vectors. Spark pairs the rows that have
to meet in a Cartesian product, which shuffles each side once and reads it again for every pair: what is written grows
with the tables, however many units a query visits. A task holds one chunk and one unit at a time, lowers the
bounds of its queries from unit to unit, and sends on only what lies within the last of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.session import durable

UNIT_VALUES = 4 * 1024 * 1024  # numbers of a packed row
UNIT_ROWS = (512, 16_384)
CHUNK_ROWS = 1_024  # chunks of queries do not get smaller than this just to use more cores
SIDE_BYTES = 64 * 1024 * 1024  # items that a task pairs with its chunk, about: Spark holds them


def unit_rows(dim: int) -> int:
    return int(min(max(UNIT_VALUES // max(dim, 1), UNIT_ROWS[0]), UNIT_ROWS[1]))


def sweep(asked: DataFrame, stock: DataFrame, want: int, dim: int, repeated: bool) -> DataFrame:
    """Lists (k1, k2, list) of the best `want` items within each query's `bound` (null: any), in parts to be merged.

    `asked` is (k1, k2, vec, bound, node) and `stock` (id, k1, vec, node), both written. What has one node is laid out
    together. One of the two also has `calls`, the nodes of the other that its row has to meet.
    """
    from vecshelf.operators import neighbours as N

    spark = asked.sparkSession
    cores = spark.sparkContext.defaultParallelism
    rows = unit_rows(dim)
    least = math.ceil(asked.count() / (2 * cores))
    left, chunks = _packed(asked, min(rows, max(CHUNK_ROWS, least)))
    right, units = _packed(stock, rows, by="id")
    sides = math.ceil(stock.count() * 8 * dim / SIDE_BYTES)
    sides = max(1, min(units, max(sides, math.ceil(2 * cores / chunks))))
    right = right.select(*[F.col(c).alias(f"to_{c}") for c in right.columns])
    meets = F.array_contains("calls", F.col("to_node")) if "calls" in asked.columns else F.array_contains("to_calls", F.col("node"))
    pairs = (
        left.repartitionById(chunks, _share(chunks, "node", "chunk"))
        .join(right.repartitionById(sides, _share(sides, "to_node", "to_chunk")).hint("shuffle_replicate_nl"), meets)
        .select("node", "chunk", "packed", "to_node", "to_packed")
    )
    entry = N._entry(stock)
    kind = T.StructType([
        T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("list", T.ArrayType(entry)),
    ])

    def run(batches):
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                node, chunk, packed, to_node, to_packed = (batch.column(c)[i] for c in range(5))
                name = (node.as_py(), chunk.as_py())
                if held is None or held.name != name:
                    if held is not None:
                        yield from held.lists()
                    held = _Chunk(name, _unpacked(packed), want, repeated)
                held.meet(to_node.as_py(), _unpacked(to_packed))
        if held is not None:
            yield from held.lists()

    return pairs.mapInArrow(run, kind)


def _share(n: int, *key: str) -> Column:
    """A partition of n: tasks are as many as the product of both sides' partitions, so neither side gets more."""
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


def _packed(rows: DataFrame, size: int, by: str | None = None) -> tuple[DataFrame, int]:
    """One row (node, chunk, packed, calls) per chunk of about `size` rows of a node, and how many there are."""
    from vecshelf.operators import tree

    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    cut, chunks = tree._chunked(rows, sizes, size)
    groups = int(chunks.agg(F.sum("chunks")).first()[0] or 1)
    calls = "calls" in rows.columns
    kind = T.StructType([
        T.StructField("node", T.LongType()), T.StructField("chunk", T.IntegerType()), T.StructField("packed", T.BinaryType()),
        *([T.StructField("calls", T.ArrayType(T.LongType()))] if calls else []),
    ])

    def pack(key, table):
        kept = table.drop_columns(["node", "chunk"])
        kept = kept.sort_by(by) if by else kept
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as out:
            out.write_table(kept.combine_chunks())
        row = {
            "node": pa.array([key[0].as_py()], pa.int64()), "chunk": pa.array([key[1].as_py()], pa.int32()),
            "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
        }
        if calls:
            met = pc.unique(table.column("calls").combine_chunks().flatten())
            row["calls"] = pa.array([met.to_pylist()], pa.list_(pa.int64()))
        return pa.table(row)

    # Groups are whole chunks, so a task each, whatever their bytes.
    return cut.repartition(groups, "node", "chunk").groupBy("node", "chunk").applyInArrow(pack, kind), groups


def _unpacked(packed: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(packed.as_buffer()).read_all()


def _calling(table: pa.Table, node: int) -> np.ndarray:
    """The rows of a table whose calls name the node; all, if it has none."""
    if "calls" not in table.column_names:
        return np.arange(table.num_rows)
    calls = table.column("calls").combine_chunks()
    owner = pc.list_parent_indices(calls).to_numpy()
    return owner[calls.flatten().to_numpy() == node]


class _Chunk:
    """Queries on their way through the units: their bounds, and what was found within them."""

    def __init__(self, name: tuple[int, int], table: pa.Table, want: int, repeated: bool):
        from vecshelf.functions.vectors import to_matrix

        self.name, self.table, self.want, self.repeated = name, table, want, repeated
        self.x = to_matrix(table.column("vec"))
        self.bound = pc.fill_null(table.column("bound"), np.inf).to_numpy().copy()
        self.best = np.full((0 if repeated else table.num_rows, want), np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def meet(self, node: int, unit: pa.Table) -> None:
        from vecshelf.functions.vectors import to_matrix
        from vecshelf.operators import neighbours as N

        mine, theirs = _calling(self.table, node), _calling(unit, self.name[0])
        if not len(mine) or not len(theirs):
            return
        if len(theirs) < unit.num_rows:
            unit = unit.take(pa.array(theirs))
        ids = unit.column("id").combine_chunks()
        codes = ids.dictionary_encode().indices.to_numpy() if self.repeated else None
        sizes, d2, place = N.nearest_in_block(self.x[mine], to_matrix(unit.column("vec")), self.want, codes)
        self._lower(mine, sizes, d2)
        row = np.repeat(mine, sizes)
        use = N.tie_key(d2) <= N.tie_key(self.bound)[row]
        if use.any():
            self.found.append((row[use], d2[use], ids.take(pa.array(place[use]))))

    def _lower(self, mine: np.ndarray, sizes: np.ndarray, d2: np.ndarray) -> None:
        """The `want`-th distance so far is a bound; of ids that may come again, only that of one unit is."""
        row = np.repeat(np.arange(len(mine)), sizes)
        met = np.full((len(mine), self.want), np.inf)
        met[row, np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]] = d2
        if not self.repeated:
            both = np.concatenate([self.best[mine], met], axis=1)
            both.sort(axis=1)
            met = self.best[mine] = both[:, : self.want]
        self.bound[mine] = np.minimum(self.bound[mine], met.max(axis=1))

    def lists(self):
        from vecshelf.operators import neighbours as N

        if not self.found:
            return
        row, d2 = (np.concatenate([f[i] for f in self.found]) for i in (0, 1))
        ids = pa.concat_arrays([f[2] for f in self.found])
        use = np.nonzero(N.tie_key(d2) <= N.tie_key(self.bound)[row])[0]
        use = use[np.argsort(row[use], kind="stable")]
        sizes = np.bincount(row[use], minlength=self.table.num_rows)
        there = np.nonzero(sizes)[0]
        entries = N._as_lists(ids, sizes[there], d2[use], use)
        keys = self.table.select(["k1", "k2"]).combine_chunks().take(pa.array(there))
        yield pa.RecordBatch.from_arrays(
            [keys.column("k1").combine_chunks(), keys.column("k2").combine_chunks(), entries], names=["k1", "k2", "list"]
        )
