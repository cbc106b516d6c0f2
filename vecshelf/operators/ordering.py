"""A dense global position over a total order, without a one-partition window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshelf.session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_position(df: DataFrame, *order: Column, out: str = "pos") -> tuple[DataFrame, int]:
    """Add the 0-based position of each row in `order` (which must be total); also return the count.

    Rows are range-partitioned and sorted; a row's position is its place in its partition plus the
    sizes of the partitions before. The sorted rows are written once, so that sizes and places come
    from the same partitions. The driver sees one number per partition.
    """
    placed = durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS).cast("int")
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts = [0, *accumulate(r["count"] for r in sizes)]
    total = starts.pop()
    if not sizes:
        return placed.withColumn(out, F.col("_place")).drop("_place"), 0
    offsets = df.sparkSession.createDataFrame(
        [(r["part"], start) for r, start in zip(sizes, starts)], "_part int, _start bigint"
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_start") + row)
        .drop("_part", "_start", "_place"),
        total,
    )
