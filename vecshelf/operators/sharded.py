"""The margin head with its classes in shards: no task and no driver holds the whole weight matrix.

Weights and the optimizer's moments are a table, one row per class. Blocks of rows meet shards of classes: a
first pass gives each row the largest logit and the sum of exponentials per shard, which add up to
its log-sum-exp; a second one, knowing it, sums the gradient of each class. The update is a step from table to table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.constants import BATCH_SIZE, MARGIN, MARGIN_SCALE, WEIGHT_DECAY
from vecshelf.functions.vectors import from_matrix, to_matrix, unit_rows
from vecshelf.operators.batching import batches
from vecshelf.operators.fit import HeadState, adamw, weight_slope
from vecshelf.operators.head import margin_terms
from vecshelf.session import durable

SHARD_VALUES = 4 * 1024 * 1024  # numbers in the weights of a shard
BLOCK_VALUES = 4 * 1024 * 1024  # numbers in the inputs of a block
_STATE = "class bigint, w array<double>, first array<double>, second array<double>"


def sharded_state(weights: DataFrame) -> DataFrame:
    """A state to start from: `(class, w, first, second)` with moments of zero, from `(class, w)`. A written table."""
    w = F.col("w").cast("array<double>")
    zero = F.transform(w, lambda v: F.lit(0.0))
    return durable(weights.select(F.col("class").cast("bigint").alias("class"), w.alias("w"), zero.alias("first"), zero.alias("second")))


def _sizes(rows: DataFrame, state: DataFrame, shards: int | None) -> tuple[int, int, int]:
    """Shards, blocks of rows and the number of classes; classes must be 0 .. C - 1, each once."""
    seen = state.agg(
        F.count(F.lit(1)).alias("n"), F.max("class").alias("top"), F.min("class").alias("low"),
        F.approx_count_distinct("class").alias("about"), F.max(F.size("w")).alias("dim"),
    ).first()
    if not seen["n"] or seen["low"] != 0 or seen["top"] != seen["n"] - 1:
        raise ValueError("classes must be 0..C-1, each once")
    n = rows.count()
    return shards or max(1, math.ceil(seen["n"] * seen["dim"] / SHARD_VALUES)), max(1, math.ceil(n * seen["dim"] / BLOCK_VALUES)), seen["n"]


def _keyed(df: DataFrame, embedding: str, label: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows under a number of their own, which stays when they are read again."""
    rows = df.select(F.col(embedding).alias("x"), F.col(label).cast("bigint").alias("y"), *keep)
    return durable(rows.withColumn("row", F.monotonically_increasing_id()))


def _beside(rows: DataFrame, state: DataFrame, shards: int, blocks: int, run, schema: str) -> DataFrame:
    """`run` on every block of rows beside every shard of classes."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))
    right = state.select("class", "w", F.pmod("class", F.lit(shards)).cast("int").alias("to_shard")).withColumn("to_block", every(blocks))
    tasks = min(shards * blocks, max(4 * rows.sparkSession.sparkContext.defaultParallelism, shards * blocks // 8))
    return (
        left.repartition(tasks, "block", "shard").groupBy("block", "shard")
        .cogroup(right.repartition(tasks, "to_block", "to_shard").groupBy("to_block", "to_shard"))
        .applyInArrow(run, schema)
    )


def _cosines(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cosines of a block's rows to a shard's classes, the classes, and where each row's own class is (-1: elsewhere)."""
    classes = right.column("class").to_numpy()
    cos = unit_rows(to_matrix(left.column("x"))) @ unit_rows(to_matrix(right.column("w"))).T
    order = np.argsort(classes)
    y = left.column("y").to_numpy()
    at = np.minimum(np.searchsorted(classes[order], y), len(classes) - 1)
    return cos, classes, np.where(classes[order][at] == y, order[at], -1)


def _sums(rows, state, shards, blocks, s: float, m: float | None, easy: bool) -> DataFrame:
    """Per row: top, total (of exponentials below it), own (the label's logit), best class of the plain maximum; `row, y, ...`."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["row", "top", "total", "own", "best"]
        if not left.num_rows or not right.num_rows:
            kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
            return pa.table([pa.array([], k) for k in kinds], names=names)
        cos, classes, own = _cosines(left, right)
        row = np.flatnonzero(own >= 0)
        z = cos * s
        if m is not None:
            z[row, own[row]] = margin_terms(cos[row, own[row]], m, easy)[0] * s
        top = z.max(axis=1)
        # Of equal logits the lowest class counts.
        best = np.where(z == top[:, None], classes[None, :], np.iinfo(np.int64).max).min(axis=1)
        mine = np.full(len(z), -np.inf)
        mine[row] = z[row, own[row]]
        values = [left.column("row"), pa.array(top), pa.array(np.exp(z - top[:, None]).sum(axis=1)), pa.array(mine), pa.array(best)]
        return pa.table(values, names=names)

    parts = _beside(rows.select("row", "x", "y"), state, shards, blocks, run, "row bigint, top double, total double, own double, best bigint")
    whole = parts.groupBy("row").agg(  # one entry a shard
        F.max("top").alias("high"), F.max("own").alias("own"), F.min(F.struct(-F.col("top"), F.col("best").alias("best")))["best"].alias("best"),
        F.collect_list(F.struct("top", "total")).alias("parts"),
    )
    total = F.aggregate(F.array_sort("parts"), F.lit(0.0), lambda acc, p: acc + p["total"] * F.exp(p["top"] - F.col("high")))
    return whole.select("row", "high", total.alias("total"), "own", "best")


def sharded_evaluate(
    df: DataFrame, state: DataFrame, key: str, label: str = "label", embedding: str = "embedding",
    batch_size: int = BATCH_SIZE, s: float = MARGIN_SCALE, shards: int | None = None,
) -> DataFrame:
    """One row, as `head.evaluate` has it: n, loss_batch_mean, loss_row_mean, loss_scaled, accuracy."""
    placed = batches(df.select(key, F.col(embedding).alias("x"), F.col(label).alias("y")), key, batch_size)
    rows = _keyed(placed, "x", "y", ("batch_id",))
    shards, blocks, n_classes = _sizes(rows, state, shards)
    _check_labels(rows, n_classes)
    loss = F.log("total") + F.col("high") - F.col("own")
    plain = _sums(rows, state, shards, blocks, 1.0, None, False).select("row", loss.alias("loss"), "best")
    scaled = _sums(rows, state, shards, blocks, s, None, False).select("row", loss.alias("scaled"))
    each = rows.select("row", "batch_id", "y").join(plain, "row").join(scaled, "row")
    sums = each.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss"), F.sum("scaled").alias("scaled"),
        F.count_if(F.col("best") == F.col("y")).alias("hits"),
    )
    n = F.sum("n")
    return sums.agg(
        n.alias("n"), F.avg(F.col("loss") / F.col("n")).alias("loss_batch_mean"), (F.sum("loss") / n).alias("loss_row_mean"),
        (F.sum("scaled") / n).alias("loss_scaled"), (F.sum("hits") / n).alias("accuracy"),
    )


def _check_labels(rows: DataFrame, n_classes: int) -> None:
    if not rows.where(F.col("y").isNull() | (F.col("y") < 0) | (F.col("y") >= n_classes)).isEmpty():
        raise ValueError(f"null label, or label outside 0..{n_classes - 1}")


def sharded_step(
    df: DataFrame, state: DataFrame, step: int, rate: float, label: str = "label", embedding: str = "embedding",
    s: float = MARGIN_SCALE, m: float = MARGIN, easy: bool = False, weight_decay: float = WEIGHT_DECAY, shards: int | None = None,
) -> tuple[DataFrame, dict]:
    """The state after one more AdamW step (from `step` done ones), as a written table, and the step's loss, accuracy and rows.

    Inputs are read in two passes, each copied once per shard. Without rows the state stays as it is.
    """
    rows = _keyed(df, embedding, label)
    shards, blocks, n_classes = _sizes(rows, state, shards)
    _check_labels(rows, n_classes)
    told = durable(rows.join(_sums(rows, state, shards, blocks, s, m, easy), "row"))
    loss = F.log("total") + F.col("high") - F.col("own")
    seen = told.agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("loss"), F.avg((F.col("best") == F.col("y")).cast("int")).alias("accuracy")).first()
    n = seen["n"]
    if not n:
        return state, seen.asDict()

    def slopes(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64()))], names=["class", "sums"])
        cos, classes, own = _cosines(left, right)
        row = np.flatnonzero(own >= 0)
        moved, slope = margin_terms(cos[row, own[row]], m, easy)
        z = cos * s
        z[row, own[row]] = moved * s
        high, total = (left.column(c).to_numpy()[:, None] for c in ("high", "total"))
        g = s * np.exp(z - high) / total
        g[row, own[row]] = (g[row, own[row]] - s) * slope
        return pa.table([pa.array(classes), from_matrix(g.T @ unit_rows(to_matrix(left.column("x"))))], names=["class", "sums"])

    parts = _beside(told.select("row", "x", "y", "high", "total"), state, shards, blocks, slopes, "class bigint, sums array<double>")
    sums = parts.groupBy("class").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))

    def update(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows:
                w, first, second, a = (to_matrix(batch.column(c)) for c in ("w", "first", "second", "sums"))
                new = adamw(HeadState(w, step, first, second), weight_slope(w, a / n), rate, weight_decay)
                columns = [batch.column("class"), *(from_matrix(x) for x in (new.weights, new.first, new.second))]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "w", "first", "second"])

    return durable(state.join(sums, "class").mapInArrow(update, _STATE)), seen.asDict()
