"""What changed between two snapshots of a catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprints(catalogue: DataFrame, id: str = "id", *columns: str) -> DataFrame:
    """`(id, print1, print2, n)` per id: a digest of its different rows, whatever their order and repeats.

    `columns` are what counts (default: all but the id). Rows without an id have none. Rows of an id are combined by sums
    and xor, so that no task gathers them.
    """
    columns = list(columns) or [c for c in catalogue.columns if c != id]
    # A null differs from any text, and neighbouring values do not run together.
    parts = [F.coalesce(F.concat(F.lit("="), F.base64(F.col(c).cast("string").cast("binary"))), F.lit("-")) for c in columns]
    rows = catalogue.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.concat_ws("|", *parts).alias("row")).distinct()
    return rows.groupBy("id").agg(
        F.bit_xor(F.xxhash64("row")).alias("print1"),
        F.bit_xor(F.conv(F.substring(F.sha2("row", 256), 1, 15), 16, 10).cast("long")).alias("print2"),
        F.count(F.lit(1)).alias("n"),
    )


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """`(id, change)` of two tables of `fingerprints`: new, changed or gone; ids that stayed as they were have no row."""
    old = before.select("id", F.struct("print1", "print2", "n").alias("old"))
    new = after.select("id", F.struct("print1", "print2", "n").alias("new"))
    change = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "gone").when(F.col("old") != F.col("new"), "changed")
    return old.join(new, "id", "full").select("id", change.alias("change")).where("change is not null")
