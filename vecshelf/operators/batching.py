"""Batches over a table: sequential or shuffled, padded, collated."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecshelf.functions.text import hash_number
from vecshelf.operators.ordering import with_position
from vecshelf.session import durable

ROUNDS = 48  # of swaps in a permutation of positions; twice the bits of a position mix well


def batches(
    df: DataFrame,
    key: str,
    size: int,
    shuffle: bool = False,
    seed: int = 0,
    epoch: int = 0,
    world: int = 1,
) -> DataFrame:
    """Add `pos`, `batch_id` and `rank`.

    In order of `key` the last batch may be short. Shuffled, rows are ordered by a hash of
    (seed, epoch, key) and shared out to `world` ranks: the order is continued from its start until
    its length divides by `world`, ranks take full batches in turn, and the rest is cut into one
    equal short batch per rank. `batch_id` is then `step * world + rank`.
    """
    if not shuffle:
        placed, _ = with_position(df, F.asc(key))
        return placed.withColumn("batch_id", F.floor(F.col("pos") / size)).withColumn(
            "rank", F.lit(0)
        )
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.lit(epoch), F.col(key).cast("string")))
    placed, n = with_position(df.withColumn("_draw", draw), F.asc("_draw"), F.asc(key))
    return _shared_out(placed.drop("_draw"), n, size, world)


def laid_out(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """`df` with its dense position in order of `key`, sorted once for all epochs, and the number of rows. A written table."""
    placed, n = with_position(df, F.asc(key))
    return durable(placed), n


def epoch_batches(placed: DataFrame, n: int, size: int, seed: int = 0, epoch: int = 0, world: int = 1) -> DataFrame:
    """Batches of one epoch over `laid_out` rows, by a permutation of their positions: nothing is sorted or shuffled.

    Adds `batch_id` and `rank` and gives `pos` its place in the epoch's order, shared out as `batches` does.
    """
    return _shared_out(placed.withColumn("pos", permuted(F.col("pos"), n, seed, epoch)), n, size, world)


def permuted(pos: Column, n: int, seed: int, epoch: int, rounds: int = ROUNDS) -> Column:
    """A permutation of 0..n-1 under the key (seed, epoch), for any n.

    Each round pairs x with k - x modulo n, for a k of the round's own, and swaps the two if a hash of the pair says so. A
    swap is its own inverse, so rounds, and hence all of them, map 0..n-1 onto itself.
    """
    if n < 2:
        return pos

    def swap(x: Column, r: Column) -> Column:
        k = hash_number(F.lit(seed), F.lit(epoch), r) % n
        other = (k - x + n) % n
        drawn = hash_number(F.lit(seed), F.lit(epoch), r, F.greatest(x, other)) % 2
        return F.when(drawn == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), pos.cast("bigint"), swap)


def _shared_out(placed: DataFrame, n: int, size: int, world: int) -> DataFrame:
    """Positions of an order to ranks and batches; see `batches`."""
    if n == 0:
        return placed.withColumn("batch_id", F.col("pos")).withColumn("rank", F.lit(0))
    total = -(-n // world) * world
    tail = total % (size * world)
    full = total - tail
    local = max(tail // world, 1)
    pos = F.col("pos")
    late = pos - full
    # A wrapped row appears at pos, pos + n, pos + 2n, ... below the total.
    repeated = placed.withColumn(
        "pos", F.explode(F.sequence(pos, F.lit(total - 1).cast("bigint"), F.lit(n).cast("bigint")))
    )
    step = F.when(pos < full, F.floor(pos / (size * world))).otherwise(full // (size * world))
    rank = F.when(pos < full, F.floor(pos / size) % world).otherwise(F.floor(late / local))
    return repeated.withColumn("rank", rank.cast("int")).withColumn(
        "batch_id", step * world + F.col("rank")
    )


def pad(df: DataFrame, pad_ids: Mapping[str, int], batch: str = "batch_id") -> DataFrame:
    """Fill arrays on the right to the longest in their batch."""
    same = W.partitionBy(batch)
    for col, value in pad_ids.items():
        missing = F.max(F.size(col)).over(same) - F.size(col)
        df = df.withColumn(col, F.concat(col, F.array_repeat(F.lit(value).cast("bigint"), missing)))
    return df


def collate(
    df: DataFrame, cols: Sequence[str], batch: str = "batch_id", order: str = "pos"
) -> DataFrame:
    """One row per batch; each column becomes the array of its values in batch order.

    A batch holds at most its size in rows. Labels come out as one-element rows, like the
    stacked `[B, 1]` matrix, when they are passed as arrays.
    """
    rows = F.array_sort(F.collect_list(F.struct(order, *cols)))
    return df.groupBy(batch).agg(rows.alias("_rows")).select(
        batch, *[F.col("_rows").getField(c).alias(c) for c in cols]
    )


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Run a user function over Arrow-backed pandas batches."""
    return df.mapInPandas(fn, schema)
