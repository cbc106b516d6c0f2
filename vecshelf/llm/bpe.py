"""Byte-level BPE through an index of pair occurrences.

All distinct words of a batch lie in one symbol array. An index maps each mergeable pair, by its rank,
to all its positions; ranks are applied in ascending order, each to all its positions at
once, and the pairs that a merge makes or breaks are updated in the lists they touch. Words met
before are remembered up to a bound, so common words are merged once per worker.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import text_of, text_rows, text_slices, tidy

#: How byte-level BPE cuts text into words: a fixed value of the vocabulary's kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LETTER, _NUMBER, _BLANK = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
#: The same for texts within Latin-1, where the three classes can be listed and plain `re` is faster.
_LATIN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
    rf"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
_WORDS = regex.compile(PATTERN)
BLOCK_BYTES = 4 << 20  # text whose words share one index; a longer row is its own block
REMEMBERED = 200_000  # words
REMEMBERED_IDS = 2_000_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in vocabulary files of this kind."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary file in JSON: merges by rank, token bytes, and added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        symbols = byte_symbols()
        as_byte = {s: b for b, s in enumerate(symbols)}
        self.byte_ids = np.array([vocab[s] for s in symbols], np.int64)
        self.token_bytes = {i: bytes(as_byte[c] for c in token) for token, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token_bytes |= {i: token.encode() for token, i in self.added.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.left, self.right = left, right
        keys = left << 32 | right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        # A merge whose product takes part in an earlier merge must go one position per word at a time.
        first_use = np.full(max(vocab.values()) + 1, len(pairs))
        ranks = np.arange(len(pairs))
        np.minimum.at(first_use, left, ranks)
        np.minimum.at(first_use, right, ranks)
        self.early = first_use[self.made] < ranks
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        keys = left << 32 | right
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.order[place], -1)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def words_of(text: str) -> list[str]:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORDS.findall(text)
    return _LATIN.findall(text)


class PairIndex:
    """Positions of every mergeable pair in the words of one symbol array."""

    def __init__(self, vocab: Vocabulary, words: list[bytes]):
        self.vocab = vocab
        raw = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words], np.int64)
        n = len(raw)
        self.symbols = vocab.byte_ids[raw]
        self.word = np.repeat(np.arange(len(words)), lengths)
        # One more cell at the end stands for "no neighbour".
        self.next = np.arange(1, n + 1)
        self.prev = np.arange(-1, n - 1)
        ends = np.cumsum(lengths)
        self.next[ends[lengths > 0] - 1] = n
        self.prev[(ends - lengths)[lengths > 0]] = n
        self.next, self.prev = np.append(self.next, n), np.append(self.prev, n)
        self.symbols = np.append(self.symbols, -1)
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(self.next[:n] < n))

    def _add(self, at: np.ndarray) -> None:
        """Put the pairs that begin at the given positions on the lists of their ranks."""
        if not len(at):
            return
        ranks = self.vocab.ranks(self.symbols[at], self.symbols[self.next[at]])
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
            held = self.lists.get(rank)
            if held is None:
                self.lists[rank] = [part]
                heapq.heappush(self.active, rank)
            else:
                held.append(part)

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Apply all merges; return the symbols that are left and their number per word."""
        vocab, symbols, after, before = self.vocab, self.symbols, self.next, self.prev
        n = len(symbols) - 1
        while self.active:
            rank = heapq.heappop(self.active)
            held = self.lists.pop(rank)
            at = np.sort(np.concatenate(held))
            at = at[np.append(True, at[1:] != at[:-1])]
            left, right = vocab.left[rank], vocab.right[rank]
            at = at[(symbols[at] == left) & (symbols[after[at]] == right)]
            if not len(at):
                continue
            if vocab.early[rank]:
                first = np.concatenate([[True], np.diff(self.word[at]) > 0])
                later, at = at[~first], at[first]
                if len(later):
                    self.lists[rank] = [later]
                    heapq.heappush(self.active, rank)
            elif left == right and len(at) > 1:
                at = _apart(at, after)
            gone = after[at]
            symbols[at] = vocab.made[rank]
            symbols[gone] = -1
            beyond = after[gone]
            after[at] = beyond
            before[beyond] = at  # the cell at the end takes what does not matter
            back = before[at]
            back = back[back < n]
            self._add(np.concatenate([back, at[beyond < n]]))
        kept = symbols[:n] >= 0
        return symbols[:n][kept], np.bincount(self.word[kept], minlength=self.word[-1] + 1 if n else 0)


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions in runs that overlap their successors, every other one from each run's begin."""
    chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
    starts = np.flatnonzero(~chained)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    return at[place % 2 == 0]


class _Codes(dict):
    """Words numbered in order of first use."""

    def __missing__(self, word) -> int:
        self[word] = code = len(self)
        return code


class Encoder:
    """Encodes blocks of texts; keeps the ids of words it has met, up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.sizes = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        if len(self.codes) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._forget()
        codes, known = self.codes, len(self.codes)
        words, per_text = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if self.vocab.split is not None and any(t in text for t in self.vocab.added):
                found = []
                for k, part in enumerate(self.vocab.split.split(text)):
                    found += [(part,)] if k % 2 else words_of(part)  # a tuple tells an added token from a word
            else:
                found = words_of(text)
            per_text[i] = len(found)
            words.extend(map(codes.__getitem__, found))
        fresh = list(codes)[known:] if len(codes) > known else []
        if fresh:
            self._learn(fresh)
        code = np.array(words, np.int32)
        del words
        sizes = self.sizes[code]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        # Where each word's ids lie, less where they go: places of ids are a range plus this shift.
        shift = ((np.cumsum(self.sizes) - self.sizes)[code] - ends[:-1]).astype(np.int32)
        ids = self.ids[np.repeat(shift, sizes) + np.arange(ends[-1], dtype=np.int32)]
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        return ids, np.diff(ends[bounds])

    def _learn(self, fresh: list) -> None:
        plain = [w.encode("utf-8", "surrogatepass") if isinstance(w, str) else b"" for w in fresh]
        ids, sizes = PairIndex(self.vocab, plain).run() if any(plain) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        sizes = np.concatenate([sizes, np.zeros(len(fresh) - len(sizes), np.int64)])
        added = [i for i, w in enumerate(fresh) if isinstance(w, tuple)]
        if added:
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends[added], [self.vocab.added[fresh[i][0]] for i in added])
            sizes[added] = 1
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])


def encoded(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id and ids, the whole text's token ids as array<int>.

    `path` names a byte-level BPE vocabulary in JSON that every executor has. Added tokens that stand in a text
    become their ids. A null or empty text gives no ids. Ids of rows may be null or repeat; other
    columns are not read; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            for part in text_slices(batch, 1, BLOCK_BYTES):
                ids, sizes = encoder.encode(part.column(1).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return text_rows(rows).mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """Add `text` to a table (doc_id, ids): the bytes of all tokens, as UTF-8; broken sequences are replaced.

    Null or empty ids give an empty text; ids that the vocabulary lacks give nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        table = [b""] * (max(vocab.token_bytes) + 1)
        for i, token in vocab.token_bytes.items():
            table[i] = token
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                values = ids.values.to_pylist() if ids.is_valid else []
                if values and not 0 <= min(values) <= max(values) < len(table):
                    values = [i for i in values if 0 <= i < len(table)]
                texts.append(b"".join(map(table.__getitem__, values)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, ids array<int>, text string")
