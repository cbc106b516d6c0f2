"""Exact dedup through counting quotient filters of text fingerprints.

Each partition builds a counting quotient filter of its fingerprints. Filters of one fingerprint
range merge by their sorted remainders without loss, so counts over the whole table are exact.
Only texts whose fingerprint counts more than once are compared byte by byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import SPACE, fresh, small_side, text_of
from vecshelf.session import durable

QUOTIENT_BITS = 10
SEGMENT_ROWS = 1 << 18  # fingerprints that a merging group gets, about
BUFFER_ROWS = 1 << 18  # fingerprints that a task gathers before it writes filters
GROUPS_SENT = 200_000  # groups of equal texts that a broadcast may hold, at some 100 bytes each
_FILTER = "segment long, runs binary, remainders binary, counts binary"


def build_filter(fingerprints: np.ndarray, counts: np.ndarray, low_bits: int) -> tuple[bytes, bytes, bytes]:
    """A counting quotient filter of distinct, sorted fingerprints that share all bits above `low_bits`.

    The top QUOTIENT_BITS of the low bits are the quotient. Kept are the length of each quotient's
    run, the remainders (sorted within runs) and their counts.
    """
    shift = np.uint64(low_bits - QUOTIENT_BITS)
    quotients = (fingerprints >> shift) & np.uint64((1 << QUOTIENT_BITS) - 1)
    runs = np.bincount(quotients.astype(np.int64), minlength=1 << QUOTIENT_BITS).astype("<u4")
    remainders = (fingerprints & np.uint64((1 << int(shift)) - 1)).astype("<u8")
    return runs.tobytes(), remainders.tobytes(), counts.astype("<i8").tobytes()


def read_filter(segment: int, runs: bytes, remainders: bytes, counts: bytes, low_bits: int):
    """The fingerprints and counts that a filter holds."""
    shift = np.uint64(low_bits - QUOTIENT_BITS)
    quotients = np.repeat(np.arange(1 << QUOTIENT_BITS, dtype=np.uint64), np.frombuffer(runs, "<u4"))
    top = np.uint64((segment << low_bits) & (2**64 - 1))
    return top | (quotients << shift) | np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<i8")


def merge_counts(fingerprints: list[np.ndarray], counts: list[np.ndarray]):
    """Merge sorted runs; counts of equal fingerprints add up."""
    values = np.concatenate(fingerprints)
    order = np.argsort(values, kind="stable")  # a merge of sorted runs
    values, numbers = values[order], np.concatenate(counts)[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[first], np.add.reduceat(numbers, first)


def repeated_fingerprints(prints: DataFrame, total: int) -> DataFrame:
    """The values of the only column (long, not null) that occur more than once, with their counts."""
    segment_bits = max(4, math.ceil(math.log2(max(1, total / SEGMENT_ROWS))))
    low_bits = 64 - segment_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            rows += batch.num_rows
            if rows >= BUFFER_ROWS:
                yield filters(held)
                held, rows = [], 0
        if rows:
            yield filters(held)

    def filters(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
        segments = (values >> np.uint64(low_bits)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1]])
        made = [
            (int(segments[a]), *build_filter(values[a:b], counts[a:b], low_bits))
            for a, b in zip(starts, [*starts[1:], len(values)])
        ]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        columns = [pa.array(x, kind) for x, kind in zip(zip(*made), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["segment", "runs", "remainders", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        parts = [read_filter(*row, low_bits) for row in group.itertuples(index=False)]
        values, counts = merge_counts([p[0] for p in parts], [p[1] for p in parts])
        twice = counts > 1
        return pd.DataFrame({"print": values[twice].view(np.int64), "copies": counts[twice]})

    built = prints.mapInArrow(build, _FILTER)
    return built.groupBy("segment").applyInPandas(merge, "print long, copies long")


def repeated_texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The texts that occur more than once: text_sha256, keep_id, group_size. A written table."""
    body = F.regexp_replace(text_of(text), SPACE, " ")
    rows = docs.select(F.col(id).alias("doc_id"), body.alias("body")).withColumn("print", F.xxhash64("body"))
    repeated = durable(repeated_fingerprints(rows.select("print"), docs.count()))
    groups = (
        rows.join(small_side(repeated.select("print")), "print", "left_semi")
        .groupBy("print", "body")  # the byte comparison; copies combine before the shuffle
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    return durable(groups.select(F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"))


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after each run of ASCII white space becomes one space; a null text
    is an empty one, and empty texts equal each other. Of equal texts the smallest id stays; null
    ids lose against all others, and if all are null each such row shows kept. Rows that repeat both
    id and text all show the same values (`deduplicate` keeps one of them). Other columns are not
    read, so their names do not matter. An empty table gives an empty result.
    """
    groups = repeated_texts(docs, id, text)
    body = F.regexp_replace(text_of(text), SPACE, " ")
    found = docs.select(F.col(id).alias("doc_id"), F.sha2(body, 256).alias("text_sha256")).join(
        small_side(groups, GROUPS_SENT), "text_sha256", "left"
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: exactly one row of each group of equal texts.

    Null texts count as empty, and empty texts equal each other. Of a group the row with the smallest id stays, of equal
    such rows one; null ids lose against all others. Columns may have any names. An empty table gives an empty result.
    """
    sha_name, keep_name, found_name = (fresh(docs, name) for name in ("_group_sha", "_group_keep", "_group"))
    groups = repeated_texts(docs, id, text).select(
        F.col("text_sha256").alias(sha_name), F.col("keep_id").alias(keep_name), F.lit(True).alias(found_name)
    )
    sha = F.sha2(F.regexp_replace(text_of(text), SPACE, " "), 256)
    found = docs.withColumn(sha_name, sha).join(small_side(groups, GROUPS_SENT), sha_name, "left")
    alone = found.where(F.col(found_name).isNull())
    first = found.where(F.col(found_name) & F.col(id).eqNullSafe(F.col(keep_name)))
    return alone.union(first.dropDuplicates([sha_name])).select(*[F.col(f"`{c}`") for c in docs.columns])
