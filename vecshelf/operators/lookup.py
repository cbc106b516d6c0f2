"""Joining many rows to a table with one row per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 500_000
NULL_SPREAD = 64


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str | Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join `rows` to `table` (at most one row per key) on `key`; `how` is inner or left.

    Keys with more than `hot_rows` rows are split: their rows go to several salts, chosen by a hash
    of the `spread` columns, and the table row is copied once per salt. A hot key has over `hot_rows`
    rows, so there are fewer than rows / hot_rows of them (200 000 for 10^11 rows) and their list can
    be broadcast; keys should be short, such as hashes. No row is dropped on any path. Salts are a function of the row, so
    a re-run task sends its rows to the same place.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    keys = [key] if isinstance(key, str) else list(key)
    present = [F.col(k).isNotNull() for k in keys]
    known = present[0]
    for cond in present[1:]:
        known = known & cond
    # Project before grouping so that the hot-key pass reads the key columns only.
    hot = (
        rows.select(*keys).where(known).groupBy(*keys).count()
        .where(F.col("count") > hot_rows)
        .select(*keys, F.ceil(F.col("count") / hot_rows).cast("int").alias("_splits"))
    )
    draw = F.xxhash64(*[F.col(c) for c in spread])
    salted = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn(
            "_salt",
            F.when(~known, F.pmod(draw, F.lit(NULL_SPREAD)))
            .otherwise(F.pmod(draw, F.coalesce("_splits", F.lit(1))))
            .cast("int"),
        )
        .drop("_splits")
    )
    copies = (
        table.join(F.broadcast(hot), keys, "left")
        .withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1))
        )
        .drop("_splits")
    )
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
