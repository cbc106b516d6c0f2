"""Alignment of two tokenizers over the same bytes, by divide and conquer at shared cuts.

Both tokenisations of a text cover the same bytes. An offset where tokens of both end is a cut. Of each
interval, a common end near the middle is located by bisection and both halves are worked on in
turn; an interval without a cut is a leaf group. All intervals of a block of texts are bisected together.

Links (pairs of overlapping tokens) are counted over the whole corpus. The commonest pairs of ids, at
most SENT_PAIRS of them, go to every worker; counts of all others come by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.bpe import PATTERN, vocabulary
from vecshelf.llm.common import BROADCAST_ROWS, text_of, text_slices, tidy
from vecshelf.operators.lookup import lookup_join
from vecshelf.session import durable

BLOCK_BYTES = 1 << 20  # text that is aligned at once; a longer row is its own block
SENT_PAIRS = 1_000_000  # id pairs with their counts that a broadcast may hold, at 17 bytes each
HELD_PAIRS = 1_000_000  # distinct id pairs that a counting task gathers before it sends them on
_BLOCKS = (
    "docs array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "shas array<string>, links binary, pairs array<long>, counts array<long>"
)


class Pair:
    """A byte-level BPE vocabulary in JSON (A) and a sentencepiece model (B), with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        vocab = vocabulary(path_a)
        added = set(vocab.added.values())
        if (np.diff(vocab.made) <= 0).any():
            raise ValueError("ids of merged tokens must follow the merges' order")
        ranks = {token: i for i, token in vocab.token_bytes.items() if i not in added}
        self.a = tiktoken.Encoding("A", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))
        ]
        self.sizes_a = [0] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.sizes_a[i] = len(token)
        self.lengths_a = np.array(self.sizes_a, np.int32)
        self.lengths_b = np.array([len(token) for token in self.bytes_b], np.int32)
        # Each id as text, followed by what can follow it.
        self.text_a = [f"{i}{end}" for i in range(len(self.sizes_a)) for end in ",|"]
        self.text_b = [f"{i}{end}" for i in range(len(self.lengths_b)) for end in ",;"]

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text, with a space before it; none where the two do not give back the same bytes."""
        found = []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            a: list[int] = []
            if text:
                raw = b" " + text.encode()
                if b"".join(map(self.bytes_b.__getitem__, b)) == raw:
                    a = self.a.encode_ordinary(" " + text)
                    if sum(map(self.sizes_a.__getitem__, a)) != len(raw):
                        a = []
            found.append((a, b if a else []))
        return found


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray):
    """Places of all ends that both sides share, as indices into both: the last tokens of groups.

    `ends_a` and `ends_b` rise; `last_a` and `last_b` are where the intervals end (at a shared end each),
    in order. Each round looks at every open interval: first at its middle end, then at the ends up
    to twice as far from it, and so on. The nearest shared one cuts the interval in two.
    """
    cut_a, cut_b = [last_a], [last_b]
    low_a, high_a = np.append(0, last_a[:-1] + 1), last_a  # candidates are low_a .. high_a - 1
    low_b, high_b = np.append(0, last_b[:-1] + 1), last_b
    reach = np.zeros(len(last_a), np.int64)
    while True:
        live = (high_a > low_a) & (high_b > low_b) & (reach <= high_a - low_a)
        low_a, high_a, low_b, high_b, reach = (x[live] for x in (low_a, high_a, low_b, high_b, reach))
        if not len(low_a):
            return np.sort(np.concatenate(cut_a)), np.sort(np.concatenate(cut_b))
        middle = (low_a + high_a - 1) >> 1
        best, place = _nearest(ends_a, ends_b, low_a, high_a, middle, reach)
        hit = best >= 0
        cut_a.append(best[hit])
        cut_b.append(place[hit])
        # A cut interval becomes two and the others stay, so that all remain in order.
        times = 1 + hit
        left = (np.cumsum(times) - times)[hit]
        reach = np.repeat(np.where(hit, 0, np.maximum(1, reach * 2)), times)
        low_a, high_a, low_b, high_b = (np.repeat(x, times) for x in (low_a, high_a, low_b, high_b))
        high_a[left], low_a[left + 1] = best[hit], best[hit] + 1
        high_b[left], low_b[left + 1] = place[hit], place[hit] + 1


def _nearest(ends_a, ends_b, low, high, middle, reach):
    """Per interval the shared end nearest to its middle, of those `reach` up to `2 * reach` away; -1 if none."""
    counts = np.maximum(1, 2 * reach)
    starts = np.cumsum(counts) - counts
    if counts[-1] == 1 and (counts == 1).all():
        at, away = middle, np.zeros(len(middle), np.int64)
    else:
        owner = np.repeat(np.arange(len(low)), counts)
        step, far = np.arange(len(owner)) - starts[owner], reach[owner]
        away = np.where(far == 0, 0, np.where(step < far, far + step, -(step + (far == 0))))
        at = middle[owner] + away
        inside = (at >= low[owner]) & (at < high[owner])
        at = np.where(inside, at, low[owner])
    value = ends_a[at]
    place = np.searchsorted(ends_b, value)
    hit = ends_b[place] == value
    if len(at) == len(low):
        return np.where(hit, at, -1), place
    rank = np.where(hit & inside, np.abs(away), np.iinfo(np.int64).max)
    least = np.minimum.reduceat(rank, starts)
    first = np.flatnonzero((rank == least[owner]) & (rank < np.iinfo(np.int64).max))
    best, found = np.full(len(low), -1), np.zeros(len(low), np.int64)
    best[owner[first]], found[owner[first]] = at[first], place[first]
    return best, found


def align(pair: Pair, texts: list[str | None]) -> dict:
    """The columns of one row of `_BLOCKS` but `docs`: figures per text, links as places in the distinct pairs."""
    encoded = pair.encode(texts)
    n_a = np.array([len(a) for a, _ in encoded], np.int64)
    n_b = np.array([len(b) for _, b in encoded], np.int64)
    a = np.fromiter(chain.from_iterable(x for x, _ in encoded), np.int64, int(n_a.sum()))
    b = np.fromiter(chain.from_iterable(x for _, x in encoded), np.int64, int(n_b.sum()))
    n_groups, n_links, shas = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [""] * len(texts)
    some = np.flatnonzero(n_a)
    if not len(some):
        none = np.zeros(0, np.int64)
        return dict(n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, shas=shas, links=b"", pairs=none, counts=none)
    ends_a, ends_b = np.cumsum(pair.lengths_a[a]), np.cumsum(pair.lengths_b[b])
    last_a, last_b = np.cumsum(n_a[some]) - 1, np.cumsum(n_b[some]) - 1
    cut_a, cut_b = shared_cuts(ends_a, ends_b, last_a, last_b)
    n_groups[some] = np.diff(np.searchsorted(cut_a, last_a), prepend=-1)
    # In a group every end but the shared one begins another overlap.
    inner = np.ones(len(b), bool)
    inner[cut_b] = False
    ends = np.sort(np.concatenate([ends_a, ends_b[inner]]), kind="stable")
    keys = a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]
    n_links[some] = np.diff(np.searchsorted(ends, ends_a[last_a]), prepend=-1)
    codes, pairs = pd.factorize(keys)
    for i, text in zip(some, _digests(pair, a, b, cut_a, cut_b, last_a)):
        shas[i] = text
    return dict(
        n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, shas=shas,
        links=codes.astype("<i4").tobytes(), pairs=pairs, counts=np.bincount(codes, minlength=len(pairs)),
    )


def _digests(pair: Pair, a, b, cut_a, cut_b, last_a) -> Iterator[str]:
    """sha256 of each text's groups as `a1,a2|b1;a3|b2,b3`."""
    code_a, code_b = a * 2, b * 2
    code_a[cut_a] += 1
    code_b[cut_b] += 1
    size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    group_a, group_b = np.repeat(np.arange(len(cut_a)), size_a), np.repeat(np.arange(len(cut_b)), size_b)
    before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b)
    order = np.empty(len(a) + len(b), np.int64)
    shift = len(pair.text_a)
    order[np.arange(len(a)) + (before_b - size_b)[group_a]] = code_a
    order[np.arange(len(b)) + (before_a + size_a)[group_b]] = code_b + shift
    texts = pair.text_a + pair.text_b
    stops = (last_a + 1) + before_b[np.searchsorted(cut_a, last_a)]
    start = 0
    codes = order.tolist()
    for stop in stops.tolist():
        yield hashlib.sha256("".join(map(texts.__getitem__, codes[start:stop]))[:-1].encode()).hexdigest()
        start = stop


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Alignments of blocks of texts, one row a block, as a written table with a number for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(path_a, path_b)
        whole = pa.list_(pa.int64())
        for batch in batches:
            for part in text_slices(batch, 1, BLOCK_BYTES):
                found = align(pair, part.column(1).to_pylist())
                columns = [pa.array([part.column(0).to_pylist()], whole)]
                columns += [pa.array([found[c]], whole) for c in ("n_a", "n_b", "n_groups", "n_links")]
                columns += [pa.array([found["shas"]], pa.list_(pa.string())), pa.array([found["links"]], pa.binary())]
                columns += [pa.array([found[c]], whole) for c in ("pairs", "counts")]
                names = ["docs", "n_a", "n_b", "n_groups", "n_links", "shas", "links", "pairs", "counts"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return durable(rows.mapInArrow(tidy(run), _BLOCKS).withColumn("block", F.monotonically_increasing_id()))


def link_counts(blocks: DataFrame) -> DataFrame:
    """How many links hold each pair of ids: pair (A id << 32 | B id), count, best. A written table.

    `best` marks pairs whose count is the highest of their B id, ties included. B ids are bounded by
    their vocabulary, hence the broadcast of their highest counts.
    """

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def sums() -> pd.Series:
            return pd.concat(held).groupby(level=0).sum()

        def out(found: pd.Series) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.index.to_numpy()), pa.array(found.to_numpy())], names=["pair", "count"])

        for batch in batches:
            pairs, counts = (batch.column(i).flatten().to_numpy() for i in (0, 1))
            held.append(pd.Series(counts, index=pairs))
            rows += len(pairs)
            if rows > 2 * HELD_PAIRS:
                held = [sums()]
                rows = len(held[0])
                if rows > HELD_PAIRS:
                    yield out(held[0])
                    held, rows = [], 0
        if held:
            yield out(sums())

    partial = blocks.select("pairs", "counts").mapInArrow(tidy(merged), "pair long, count long")
    counts = durable(partial.groupBy("pair").agg(F.sum("count").alias("count")))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    return durable(
        counts.withColumn("b", b).join(F.broadcast(highest), "b")
        .select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    )


def commonest(counts: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """The pairs of highest counts, at most `limit`, and whether those are all."""
    total = counts.count()
    if total <= limit:
        return counts, True
    # Counts by powers of two: one row a power, so that the driver sees few.
    power = F.floor(F.log2("count")).cast("int")
    sizes = {r["power"]: r["n"] for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, kept = max(sizes) + 1, 0
    while kept + sizes.get(least - 1, 0) <= limit:
        least -= 1
        kept += sizes.get(least, 0)
    return counts.where(power >= least), False


def aligned(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text",
            sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a space and the text, B the text (to which it adds the space); strings of special tokens are plain text.
    Texts that are null or empty, or of which the tokens' bytes are not the text's (B may normalise), show zeros
    and '' for the digest. A link is a pair of token occurrences whose bytes overlap; its count is the number of links
    in the corpus with its pair of ids. Rows may repeat and ids may be null: each row counts. Other columns
    are not read. An empty table gives an empty result.
    """
    blocks = aligned_blocks(docs, path_a, path_b, id, text)
    counts = link_counts(blocks)
    common, all_sent = commonest(counts, sent_pairs)
    known = common.orderBy("pair").toArrow()
    sent = docs.sparkSession.sparkContext.broadcast(
        (known["pair"].to_numpy(), known["count"].to_numpy(), np.asarray(known["best"].to_numpy(), bool))
    )
    if not all_sent:
        blocks = _with_rare(blocks, counts, sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers, bests = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                at = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
                pairs = at["pairs"].values.to_numpy()
                count, best = _looked_up(pairs, keys, numbers, bests)
                if "rare" in at and at["rare"].is_valid:
                    rare = at["rare"].values
                    place = pd.Index(pairs).get_indexer(rare.field("pair").to_numpy())
                    count[place] = rare.field("count").to_numpy()
                    best[place] = rare.field("best").to_numpy(zero_copy_only=False)
                links = np.frombuffer(at["links"].as_py(), "<i4")
                n_links = at["n_links"].values.to_numpy()
                ends = np.append(0, np.cumsum(n_links))
                best_sum, count_sum = (np.append(0, np.cumsum(x[links]))[ends] for x in (best.astype(np.int64), count))
                columns = [at[c].values for c in ("docs", "n_a", "n_b", "n_groups", "n_links")]
                columns += [pa.array(np.diff(best_sum)), pa.array(np.diff(count_sum)), at["shas"].values]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names)
    read = ["docs", "n_a", "n_b", "n_groups", "n_links", "shas", "links", "pairs", *(["rare"] if not all_sent else [])]
    return blocks.select(*read).mapInArrow(tidy(run), schema)


def _looked_up(pairs, keys, numbers, bests) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    place = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    there = keys[place] == pairs
    return np.where(there, numbers[place], 0), there & bests[place]


def _with_rare(blocks: DataFrame, counts: DataFrame, sent) -> DataFrame:
    """`blocks` with `rare`: pair, count and best of the block's pairs that were not sent to all workers."""

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value[0]
        for batch in batches:
            for row in range(batch.num_rows):
                pairs = batch.column(1)[row].values.to_numpy()
                if len(keys):
                    pairs = pairs[keys[np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)] != pairs]
                blocks = pa.array(np.full(len(pairs), batch.column(0)[row].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays([blocks, pa.array(pairs, pa.int64())], names=["block", "pair"])

    needed = durable(blocks.select("block", "pairs").mapInArrow(tidy(missing), "block long, pair long"))
    rare = (
        lookup_join(needed, counts, "pair", spread=["block"])
        .groupBy("block").agg(F.collect_list(F.struct("pair", "count", "best")).alias("rare"))  # a block's pairs: bounded
    )
    return blocks.join(rare, "block", "left")
