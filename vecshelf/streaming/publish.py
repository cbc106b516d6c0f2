"""Publication from a stream of catalogue changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecshelf.constants import DEEP_DIM, NEIGHBOURS, ON_SHELF
from vecshelf.operators.embed import Encoder
from vecshelf.plans.daily import run_changes
from vecshelf.sinks.shelf import Shelf


def publish_stream(
    changes: DataFrame, path: str, checkpoint: str, encoder_factory: Callable[[], Encoder], version: str, now: Column,
    dim: int = DEEP_DIM, k: int = NEIGHBOURS, up: str = ON_SHELF, available_now: bool = True, **options,
) -> StreamingQuery:
    """Start a query that keeps the shelf at `path` up to a stream `(id, name, status, at)`.

    Within a batch the last row of an id counts (by `at`, then name and status); an id whose status is not `up` is gone. Each batch is
    one version of the shelf, tagged with the batch's number, so a batch that Spark replays after a failure
    changes nothing. Run it with one checkpoint folder per shelf.
    """

    def apply(batch: DataFrame, number: int) -> None:
        shelf = Shelf(batch.sparkSession, path)
        last = batch.where("id is not null").groupBy("id").agg(F.max(F.struct("at", "name", "status")).alias("r"))
        last = last.select("id", "r.name", F.coalesce(F.col("r.status") == up, F.lit(False)).alias("up"))
        run_changes(
            shelf, last.where("up").select("id", "name"), last.where("not up").select("id"), encoder_factory, version, now,
            dim, k, tag=number, **options,
        )

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
