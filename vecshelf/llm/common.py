"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20  # text that a task works on at once, unless one row alone is longer
BROADCAST_ROWS = 1_000_000  # of fixed-width rows: at most some 16 MB sent, 64 MB hashed

ARROW_ROWS = 1_000  # rows of whole texts that go to a Python worker at a time

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, a task's work on batches, giving freed memory back to the system at its end.

    Workers are used again, and what allocators keep back would otherwise add up from task to task.
    """

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_rows(df: DataFrame) -> DataFrame:
    """`df`, whose rows hold whole texts, with Arrow batches of ARROW_ROWS rows instead of Spark's default.

    The setting is the session's; one that the user has chosen stays.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df


def text_slices(batch: pa.RecordBatch, column: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about `limit` bytes of `column`; one row at least."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(lengths, dtype=np.int64) // limit
    starts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def coded(words: list) -> tuple[np.ndarray, list]:
    """Dense codes of `words` and the distinct words in order of first appearance."""
    values = np.empty(len(words), dtype=object)
    values[:] = words
    codes, distinct = pd.factorize(values)
    return codes, list(distinct)


def hashes(words: list, seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until `df` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remainder(id: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`: the folds that training rows are told apart by."""
    return F.pmod(F.crc32(F.col(id).cast("string")), F.lit(of))


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast if it has at most `limit` rows. `df` is read twice: pass a written one."""
    return F.broadcast(df) if df.count() <= limit else df


def bounded_sample(labels: DataFrame, id: str, rows: int, seed: int) -> DataFrame:
    """About `rows` rows of `labels` (all, if fewer), chosen by a hash of the id: the same in every run.

    The number of rows is binomial around `rows`, so a broadcast of the result is bounded by it.
    """
    total = labels.count()
    if total <= rows:
        return labels
    draw = F.pmod(F.xxhash64(F.col(id).cast("string"), F.lit(seed)), F.lit(1 << 30))
    return labels.where(draw < int((1 << 30) * rows / total))
