"""Looking up tokens in a table that every Python worker has."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1024 * 1024


class TokenIndex:
    """Places of tokens in a column of distinct ones, by sorted 64-bit hashes.

    It is sent by broadcast, and what is derived from the table is made at first use: once per Python worker, as Spark
    keeps a broadcast's value there, however many batches and tasks the worker has.
    """

    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()  # before it is sent, so that no worker has to copy it

    def __getstate__(self):
        return {"table": self.table}

    @cached_property
    def tokens(self) -> pa.Array:
        return self.table.column("token").combine_chunks()

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        hashes = _hashes(self.tokens)
        order = np.argsort(hashes, kind="stable")
        return hashes[order], order

    def find(self, asked: pa.Array) -> np.ndarray:
        """The place of each asked token, -1 for unknown ones and nulls. Each different token is probed once."""
        coded = asked.dictionary_encode()
        distinct = coded.dictionary
        codes = pc.fill_null(coded.indices, len(distinct)).to_numpy(zero_copy_only=False)
        return np.append(self._places(distinct), -1)[codes]

    def _places(self, distinct: pa.Array) -> np.ndarray:
        hashes, order = self._sorted
        found = np.full(len(distinct), -1, np.int64)
        if not len(hashes) or not len(distinct):
            return found
        wanted = _hashes(distinct)
        at = np.searchsorted(hashes, wanted)
        left = np.arange(len(distinct))
        while len(left):  # once, unless hashes collide
            inside = at[left] < len(hashes)
            left = left[inside]
            left = left[hashes[at[left]] == wanted[left]]
            place = order[at[left]]
            same = pc.equal(self.tokens.take(pa.array(place)), distinct.take(pa.array(left))).to_numpy(zero_copy_only=False)
            found[left[same]] = place[same]
            left = left[~same]
            at[left] += 1
        return found


def _hashes(tokens: pa.Array) -> np.ndarray:
    words = (t for part in sliced(tokens, SLICE_BYTES) for t in part.to_pylist())
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in words), np.uint64, len(tokens))


def sliced(rows: pa.Array | pa.RecordBatch, size: int) -> Iterator[pa.Array | pa.RecordBatch]:
    """Slices of about `size` bytes, so that few of the rows are Python objects at a time."""
    step = max(1, int(size * len(rows) // max(rows.nbytes, 1)))
    for start in range(0, len(rows), step):
        yield rows.slice(start, step)
