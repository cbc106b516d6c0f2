"""Labelled text files: a header line per file, a fixed number of separated fields, no quoting."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.operators.clean import split_rejects

FIELDS_CSV = ("query", "label")
FIELDS_TSV = ("query", None, "label")


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """`(value)`: all lines but the first of each file, found by position and never by content.

    The first line of a file is the first row of its block that starts at byte 0. A task reads a
    block's rows in order, so one narrow pass over these blocks finds it; lines of other blocks do not
    leave the JVM.
    """
    lines = spark.read.text(path).select(
        "value",
        (F.col("_metadata.file_block_start") == 0).alias("head"),
        F.xxhash64("_metadata.file_path").alias("file"),
    )

    def skip_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            head = batch.column("head").to_numpy(zero_copy_only=False)
            keep = np.ones(batch.num_rows, dtype=bool)
            files, firsts = np.unique(
                batch.column("file").to_numpy()[head], return_index=True
            )
            rows = np.nonzero(head)[0]
            for file, first in zip(files.tolist(), firsts.tolist()):
                if file not in seen:
                    seen.add(file)
                    keep[rows[first]] = False
            yield batch.select(["value"]).filter(pa.array(keep))

    rest = lines.where("not head").select("value")
    return rest.union(lines.where("head").mapInArrow(skip_headers, "value string"))


def parse_labelled(
    lines: DataFrame,
    sep: str = ",",
    fields: Sequence[str | None] = FIELDS_CSV,
    mode: str = "fail",
    value: str = "value",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Split lines into the named fields (None skips one). A wrong field count fails the job, or
    with `mode="reject"` goes to a second frame `(text, reason)`."""
    cut = F.split(F.col(value), "\\Q" + sep + "\\E", -1)
    right = F.size("_f") == len(fields)
    split = lines.select(F.col(value).alias("_line"), cut.alias("_f"))
    named = [F.get("_f", F.lit(i)).alias(name) for i, name in enumerate(fields) if name]
    if mode == "fail":
        message = F.concat(F.lit(f"expected {len(fields)} fields: "), F.col("_line"))
        # A filter, so that the check runs whichever columns are read.
        checked = F.when(right, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        return split.where(checked).select(*named)
    if mode != "reject":
        raise ValueError(mode)
    good, rejects = split_rejects(
        split.withColumn("_id", F.lit(None).cast("string")), "_id", "_line", {"field_count": ~right}
    )
    return good.select(*named), rejects.select("text", "reason")


def read_labelled(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    fields: Sequence[str | None] = FIELDS_CSV,
    mode: str = "fail",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    return parse_labelled(read_lines(spark, path), sep, fields, mode)
