"""Neighbour lists as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = ","


def list_text(ids: Column) -> Column:
    """Ids joined by commas, without leading or trailing commas (also those of the ids)."""
    return F.btrim(F.array_join(F.transform(ids, lambda x: x.cast("string")), SEPARATOR), F.lit(SEPARATOR))


def neighbour_lists(neighbours: DataFrame) -> DataFrame:
    """`(id, value)` from `(id, neighbour_id, rank)`; a list has `k` entries, so a group is small."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "neighbour_id")))
    return neighbours.groupBy("id").agg(ordered.alias("_l")).select(
        "id", list_text(F.col("_l.neighbour_id")).alias("value")
    )


def format_lists(lists: DataFrame) -> DataFrame:
    """`(id, value)` from the arrays of `knn_lists`, row by row."""
    return lists.select("id", list_text(F.col("neighbours.neighbour_id")).alias("value"))
