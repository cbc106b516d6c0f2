"""Publishing neighbour lists as keyed records that expire."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.constants import KEY_PREFIX, TTL_SECONDS
from vecshelf.functions.text import record_key
from vecshelf.session import durable

Writer = Callable[[list[tuple]], None]


def records(
    lists: DataFrame,
    model: str | None,
    now: Column,
    prefix: str = KEY_PREFIX,
    ttl_s: int = TTL_SECONDS,
) -> DataFrame:
    """`(key, value, written_at, expires_at)` from `(id, value)`.

    The key is `prefix:id`, or `prefix:model:id` where two models must not overwrite each other.
    """
    parts = [F.col("id")] if model is None else [F.lit(model), F.col("id")]
    return lists.select(
        record_key(prefix, *parts).alias("key"),
        "value",
        now.alias("written_at"),
        (now + F.make_dt_interval(secs=F.lit(ttl_s))).alias("expires_at"),
    )


def latest(published: DataFrame) -> DataFrame:
    """One record per key: the last written (of equal times, the larger value)."""
    last = F.max(F.struct("written_at", "value", "expires_at"))
    return published.groupBy("key").agg(last.alias("_r")).select(
        "key", "_r.value", "_r.written_at", "_r.expires_at"
    )


def live(published: DataFrame, now: Column) -> DataFrame:
    """The records a reader sees at `now`: last write per key, not yet expired."""
    return latest(published).where(F.col("expires_at") > now)


def compact(spark: SparkSession, path: str, to: str, now: Column) -> DataFrame:
    """Write the live records of `path` to the new folder `to`; superseded and expired ones go."""
    live(spark.read.parquet(path), now).write.parquet(to)
    return spark.read.parquet(to)


def publish(
    lists: DataFrame,
    model: str | None,
    now: Column,
    prefix: str = KEY_PREFIX,
    ttl_s: int = TTL_SECONDS,
    path: str | None = None,
    writer: Callable[[], Writer] | None = None,
    batch: int = 10_000,
) -> DataFrame:
    """Make records and write them, one per key; returns them. Records are computed once for all targets.

    `path`: appended as Parquet; readers use `latest` or `live`, so a repeated run is harmless, and
    `compact` takes out what no reader sees.
    `writer`: called once per partition to open an external store; the function it gives gets the
    records in batches of `(key, value, expires_at)`. Setting a key twice to the same record must
    be harmless there, since a lost task runs again.
    """
    made = durable(latest(records(lists, model, now, prefix, ttl_s)))
    if path is not None:
        made.write.mode("append").parquet(path)
    if writer is not None:
        def send(rows: Iterator) -> None:
            write = writer()
            found = ((r["key"], r["value"], r["expires_at"]) for r in rows)
            while part := list(islice(found, batch)):
                write(part)

        made.foreachPartition(send)
    return made
