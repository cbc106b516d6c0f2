"""Toxicity from the nearest labelled examples by exact cosine of weighted TF-IDF vectors.

Terms are words and their beginnings; every term of the examples is in the index. A term's weight is its
logarithmic frequency times its inverse document frequency times a factor that is lower the less
the term tells toxic from other examples. Examples with equal vectors are one entry that counts all of them. Entries lie
in blocks, and long posting lists keep the largest weight of each block: blocks are scored in order of
their bounds until none can reach the k-th best, so neighbours are exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import BLOCK_BYTES, bounded_sample, coded, give_back, mix64, text_of, text_slices, tidy
from vecshelf.session import durable

TRAIN_ROWS = 24_000  # bound of the labelled sample, hence of the index that each worker holds
SURE_Z = 4.3  # a term that differs so surely has its full weight, as hundreds of thousands are tried
LEAST_WORTH = 1e-3  # of a term that does not differ at all
PREFIXES = (4, 6)  # code points
LONG_WORD = 64  # code points
NEIGHBOURS = 15
LEVELS = 4  # of counts: 1, 2, 3 and more
LEVEL_WEIGHTS = np.append(0, 1 + np.log(np.arange(1, LEVELS + 1, dtype=np.uint8))).astype(np.float64)  # as `vector` has them
BLOCK = 64  # entries that share a bound
LONG_LIST = 64  # entries of a frequent term, at least
LONG_SHARE = 8  # or this share of all entries: below it, adding postings takes less time than a matrix
MATRIX_CELLS = 20_000_000  # weights of frequent terms at most; other lists stay postings
LIGHT = 0.03  # of the examples' squared weights: terms of least worth with so much are light
LIGHT_TEXT = 0.1  # of a text's squared weights: if its light terms have more, they are added as others are
GROUPS = 32  # of light terms
FIRST, STEP = 8, 64  # blocks that a text is compared with first, and how many times more each time after
MEASURED = 256  # entries whose whole vectors are read at once
BATCH = 250  # texts that are searched together
ROUNDING = np.float32(2e-5)  # of single-precision sums, by which bounds are raised
PRIOR_WEIGHT = 0.5
SEED = 23
EVIDENCE = 3  # neighbours that are shown
REJECTED = 0.7


def word_terms(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of words as 63-bit hashes [word, 1 + len(PREFIXES)], and which of them the word has.

    The first is the word in lower case without the marks around it, the others are its beginnings. Hashes
    run over code points, all words at once; words of over LONG_WORD code points are hashed on their own.
    """
    marks = "".join(c for c in set().union(*map(set, words)) if not c.isalnum()) if words else ""
    cores = [w.lower().strip(marks) for w in words]
    lengths = np.array([len(c) for c in cores], np.int64)
    by = np.argsort(lengths, kind="stable")  # words of over j code points are the last ones
    points = np.frombuffer("".join([cores[i] for i in by]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ordered = lengths[by]
    starts = np.cumsum(ordered) - ordered
    hashes = np.zeros((len(words), 1 + len(PREFIXES)), np.uint64)
    states = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for j in range(int(min(lengths.max(initial=0), LONG_WORD))):
        first = np.searchsorted(ordered, j, side="right")
        live = states[first:]
        live ^= points[starts[first:] + j]
        live *= np.uint64(0x100000001B3)
        live ^= live >> np.uint64(29)
        if j + 1 in PREFIXES:
            hashes[by[first:], 1 + PREFIXES.index(j + 1)] = mix64(live + np.uint64(j + 1))
    state = np.empty_like(states)
    state[by] = states
    hashes[:, 0] = mix64(~state)
    for i in np.flatnonzero(lengths > LONG_WORD):
        hashes[i, 0] = xxhash.xxh3_64_intdigest(cores[i].encode("utf-8", "surrogatepass"))
    held = np.column_stack([lengths > 0, *(lengths >= n for n in PREFIXES)])
    return (hashes >> np.uint64(1)).astype(np.int64), held


class TermReader:
    """Term counts of texts for a vocabulary (sorted term hashes), or for any terms if it is None."""

    def __init__(self, vocabulary: np.ndarray | None):
        self.vocabulary = vocabulary

    def counts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its distinct terms (their places in the vocabulary) and how often each occurs."""
        split = [t.split() for t in texts]
        codes, distinct = coded([w for ws in split for w in ws])
        found, held = word_terms(distinct)
        if self.vocabulary is not None:
            at = np.searchsorted(self.vocabulary, found)
            at[at == len(self.vocabulary)] = 0
            held &= (self.vocabulary[at] == found) if len(self.vocabulary) else False
            found = at
        sizes = held.sum(axis=1)
        flat = found[held]
        starts = np.cumsum(sizes) - sizes
        at = 0
        for ws in split:
            own = codes[at : at + len(ws)]
            at += len(ws)
            own = own[sizes[own] > 0] if len(own) else own
            if not len(own):
                yield np.zeros(0, np.int64), np.zeros(0, np.int64)
                continue
            yield np.unique(flat[_spans(starts[own], sizes[own])], return_counts=True)


class Entries(NamedTuple):
    """Distinct example vectors in blocks of BLOCK, and the inverted index over them.

    A list of postings is ordered by the level of the count, so a weight of a term and level is kept once. Frequent
    terms have none: their weights stand in a matrix, with the largest of each block beside it. Its last GROUPS columns
    are the lengths of entries in the groups of light terms, those of least worth with LIGHT of all squared weights.
    """

    vocabulary: np.ndarray  # sorted term hashes
    worth: np.ndarray  # weight of each term
    pointers: np.ndarray  # where the postings of a term and level begin
    postings: np.ndarray  # entries, by term and level
    column: np.ndarray  # of each term among the frequent ones, or -1
    group: np.ndarray  # column of the group of each light term, or -1
    matrix: np.ndarray  # [block, place in it, column]: weights of frequent terms, lengths in groups
    most: np.ndarray  # [column, block]: the largest weight
    starts: np.ndarray  # where the terms of an entry begin
    terms: np.ndarray  # by entry and then term
    weights: np.ndarray  # of vectors of length 1
    shares: np.ndarray  # of an entry: by what its weights were multiplied to be of length 1
    examples: np.ndarray
    positives: np.ndarray
    ids: np.ndarray  # the smallest example id of each entry
    blank: tuple[int, int]  # examples without a term, and toxic ones of them


def vector(places: np.ndarray, counts: np.ndarray, worth: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * worth[places]
    return weights / np.sqrt(weights @ weights)


def _frequent(lengths: np.ndarray, entries: int, long: int | None) -> np.ndarray:
    """The column of each term whose list has over `long` entries, or -1; the longest lists, if the matrix is full."""
    long = max(LONG_LIST, entries // LONG_SHARE) if long is None else long
    chosen = np.flatnonzero(lengths > long)
    room = max(1, MATRIX_CELLS // max(1, entries))
    if len(chosen) > room:
        chosen = np.sort(chosen[np.argsort(-lengths[chosen], kind="stable")[:room]])
    column = np.full(len(lengths), -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    return column


def _light(worth: np.ndarray, mass: np.ndarray, column: np.ndarray, entries: int, width: int) -> np.ndarray:
    """The column of the group of each light term, or -1: terms of least worth that are not frequent.

    `mass` is what the squared weights of a term sum to over the entries.
    """
    rest = np.flatnonzero(column < 0)
    rest = rest[np.argsort(worth[rest], kind="stable")]
    light = rest[: np.searchsorted(np.cumsum(mass[rest]), LIGHT * entries)]
    group = np.full(len(worth), -1, np.int32)
    group[light] = width + np.arange(len(light)) % GROUPS
    return group


def build(vocabulary: np.ndarray, worth: np.ndarray, examples: Iterable[tuple[int, int, np.ndarray, np.ndarray]],
          long: int | None = None) -> Entries:
    """The index of examples (id, label, places, counts); `vocabulary` is sorted. Terms in over `long` entries are frequent."""
    entries: dict[bytes, int] = {}
    blank = [0, 0]
    held, lists = [], []
    lengths = np.zeros(len(vocabulary), np.int64)
    for id_, label, places, counts in examples:
        if not len(places):
            blank[0] += 1
            blank[1] += label
            continue
        # Counts above 3 are one level, so that equal evidence meets in one entry.
        places, level = np.asarray(places, np.int32), np.minimum(counts, LEVELS).astype(np.uint8)
        e = entries.setdefault(xxhash.xxh3_128_digest(places.tobytes() + level.tobytes()), len(held))
        if e == len(held):
            unit = vector(places, level, worth)
            held.append([0, 0, id_, int(places[unit.argmax()]), unit[0] / (LEVEL_WEIGHTS[level[0]] * worth[places[0]])])
            lists.append((places, level, unit.astype(np.float32)))
            lengths[places] += 1
        held[e][0] += 1
        held[e][1] += label
        held[e][2] = min(held[e][2], id_)
    del entries
    n = len(held)
    column = _frequent(lengths, n, long)
    blocks, width = -(-n // BLOCK), int(column.max(initial=-1)) + 1
    # Entries of one strongest term stand together, which keeps the blocks' bounds low.
    order = sorted(range(n), key=lambda e: (held[e][3], held[e][2]))
    starts = np.concatenate([[0], np.cumsum([len(lists[e][0]) for e in order], dtype=np.int64)])
    terms, levels = np.zeros(starts[-1], np.int32), np.zeros(starts[-1], np.uint8)
    weights = np.zeros(starts[-1], np.float32)
    sizes, mass = np.zeros(len(vocabulary) * LEVELS, np.int32), np.zeros(len(vocabulary))
    for i, e in enumerate(order):
        part = slice(starts[i], starts[i + 1])
        places, level, unit = lists[e]
        lists[e] = None
        terms[part], levels[part], weights[part] = places, level, unit
        sizes[_rows(places, level)] += 1
        mass[places] += unit * unit
        places = level = unit = None
    del lists
    give_back()  # some 9 bytes a weight, in small pieces that larger arrays cannot use
    sizes[np.repeat(column >= 0, LEVELS)] = 0
    pointers = np.zeros(len(sizes) + 1, np.int32 if starts[-1] < 1 << 31 else np.int64)
    np.cumsum(sizes, out=pointers[1:])
    group = _light(worth, mass, column, n, width)
    del sizes, mass
    postings = np.zeros(pointers[-1], np.int32)
    matrix = np.zeros((blocks, BLOCK, width + GROUPS), np.float32)
    filled = pointers[:-1].copy()
    for i in range(n):
        part = slice(starts[i], starts[i + 1])
        own, unit, cells = terms[part], weights[part], matrix[i // BLOCK, i % BLOCK]
        light = group[own] >= 0
        cells += np.sqrt(np.bincount(group[own[light]], unit[light].astype(np.float64) ** 2, width + GROUPS))
        there = column[own] >= 0
        cells[column[own[there]]] = unit[there]
        rows = _rows(own, levels[part])[~there]
        postings[filled[rows]] = i
        filled[rows] += 1
    del filled, levels
    columns = [np.array([held[e][i] for e in order], np.int64) for i in range(3)]
    return Entries(
        np.asarray(vocabulary, np.int64), worth, pointers, postings, column, group, matrix, matrix.max(axis=1).T.copy(), starts,
        terms, weights, np.array([held[e][4] for e in order], np.float64), *columns, tuple(blank),
    )


def _rows(terms: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return terms * np.int64(LEVELS) + levels - 1


class Examples:
    """What the driver holds of the examples: packed term lists. Each worker makes its index of them once."""

    def __init__(self, vocabulary: np.ndarray, worth: np.ndarray, packed: pa.Table):
        self.vocabulary, self.worth, self.packed, self.index = vocabulary, worth, packed, None

    def __getstate__(self):
        return self.__dict__ | {"index": None}

    def entries(self) -> Entries:
        if self.index is None:
            ids, labels = (self.packed.column(c).to_pylist() for c in ("id", "label"))
            lists = self.packed.column("terms")
            order = sorted(range(len(ids)), key=lambda i: (ids[i], labels[i]))
            self.index = build(
                self.vocabulary, self.worth, ((ids[i], labels[i], *_unpacked(lists[i].as_py())) for i in order)
            )
        return self.index


def _packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    return zlib.compress(np.diff(places, prepend=0).astype(np.int32).tobytes() + np.minimum(counts, 4).astype(np.uint8).tobytes(), 1)


def _unpacked(terms: bytes) -> tuple[np.ndarray, np.ndarray]:
    whole = zlib.decompress(terms)
    n = len(whole) // 5
    return np.cumsum(np.frombuffer(whole, np.int32, n)), np.frombuffer(whole, np.uint8, n, 4 * n)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs that begin at `starts`."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _measured(index: Entries, entries: np.ndarray, places: np.ndarray, weights: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Cosines of entries on their whole vectors; `dense` is zero before and after."""
    dense[places] = weights
    a, n = index.starts[entries], index.starts[entries + 1] - index.starts[entries]
    at = _spans(a, n)
    products = dense[index.terms[at]] * index.weights[at]
    dense[places] = 0
    return np.add.reduceat(products, np.cumsum(n) - n)


class Search:
    """Nearest entries of batches of texts."""

    def __init__(self, index: Entries):
        self.index = index
        self.blocks = len(index.matrix)
        self.dense = np.zeros(len(index.worth))
        self.visited = 0  # blocks that were scored, of `asked`
        self.asked = 0

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text (places, weights) the k entries of highest cosine above 0, ties to the smaller example id.

        Postings are added first. A text's light terms, if they are little of it, are not: an entry gains by them no more
        than the product of both lengths in each group. Blocks are then scored in order of what they can reach, by the
        largest weights of the block, and those that cannot reach a text's k-th best are left out. Entries whose score,
        which is an upper bound, reaches the k-th best are measured on their whole vectors.
        """
        index, n = self.index, len(texts)
        if not n or not len(index.ids):
            return [(np.zeros(0, np.int64), np.zeros(0))] * n
        asked = np.zeros((n, index.matrix.shape[2]), np.float32)
        scores = np.zeros((n, self.blocks, BLOCK), np.float32)
        for i, (places, weights) in enumerate(texts):
            column, group = index.column[places], index.group[places]
            at, light = column >= 0, group >= 0
            asked[i, column[at]] = weights[at]
            squares = np.bincount(group[light], weights[light] ** 2, asked.shape[1])
            if squares.sum() <= LIGHT_TEXT:
                asked[i] += np.sqrt(squares)
                at |= light
            scores[i].reshape(-1)[: len(index.ids)] = self._posted(places[~at], weights[~at])
        bounds = scores.max(axis=2)
        bounds += asked @ index.most
        bounds[bounds > 0] += ROUNDING
        order = np.argsort(-bounds, axis=1)
        found = [(np.zeros(0, np.int64), np.zeros(0))] * n
        least = np.zeros(n)  # the k-th highest cosine so far
        at, step, rows = 0, FIRST, np.arange(n)
        while at < self.blocks and len(rows):
            part = order[rows, at : at + step]
            reach = bounds[rows[:, None], part]
            wanted = (reach >= least[rows][:, None]) & (reach > 0)
            rows, part, wanted = (x[wanted.any(axis=1)] for x in (rows, part, wanted))
            row, block = np.repeat(rows, wanted.sum(axis=1)), part[wanted]
            by = np.argsort(block, kind="stable")
            for group in np.split(by, np.flatnonzero(np.diff(block[by])) + 1) if len(by) else ():
                own = row[group]
                scores[own, block[group[0]]] += asked[own] @ index.matrix[block[group[0]]].T
            self.visited += len(block)
            for r, seen in zip(rows, (p[w] for p, w in zip(part, wanted))):
                found[r], least[r] = self._measured(texts[r], scores[r], seen, found[r], least[r], k)
            at, step = at + step, STEP * step
        self.asked += n * self.blocks
        return found

    def _measured(self, text, scores, blocks, found, least, k) -> tuple[tuple[np.ndarray, np.ndarray], float]:
        """The best k of `found` and of the entries of `blocks`, and the k-th cosine."""
        bounds = scores[blocks].ravel()
        at = np.flatnonzero((bounds >= least - ROUNDING) & (bounds > 0))
        if len(at) > k:
            at = at[np.argsort(-bounds[at])]
        size = k
        while len(at):
            now, at = at[:size], at[size:]
            entries = blocks[now // BLOCK] * BLOCK + now % BLOCK
            s = _measured(self.index, entries, *text, self.dense)
            entries, s = (np.concatenate([a, b[s > 0]]) for a, b in zip(found, (entries, s)))
            best = np.lexsort((self.index.ids[entries], -s))[:k]
            found = entries[best], s[best]
            least = found[1][-1] if len(best) == k else 0.0
            at, size = at[bounds[at] >= least - ROUNDING], MEASURED
        return found, least

    def _posted(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the postings of a text's terms add to each entry's score."""
        index = self.index
        starts, ends = index.pointers[places * LEVELS], index.pointers[places * LEVELS + LEVELS]
        found = [index.postings[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        if not found:
            return np.zeros(len(index.ids))
        rows = (places[:, None] * LEVELS + np.arange(LEVELS)).ravel()
        each = ((weights * index.worth[places])[:, None] * LEVEL_WEIGHTS[1:]).ravel()
        each = np.repeat(each, index.pointers[rows + 1] - index.pointers[rows])
        return np.bincount(np.concatenate(found), each, len(index.ids)) * index.shares


def nearest(index: Entries, places: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entries of one text."""
    return Search(index).nearest([(places, weights)], k)[0]


def vote(index: Entries, entries: np.ndarray, cosines: np.ndarray) -> float:
    """The share of toxic examples among the neighbours, nearer ones with more weight; drawn to the base rate."""
    total, toxic = index.examples.sum() + index.blank[0], index.positives.sum() + index.blank[1]
    base = toxic / total if total else 0.5
    if not len(entries):
        return float((index.blank[1] + base) / (index.blank[0] + 1))
    weight = cosines**2 / (1.02 - np.minimum(cosines, 1.0)) * np.sqrt(index.examples[entries])
    share = index.positives[entries] / index.examples[entries]
    return float((weight @ share + PRIOR_WEIGHT * base) / (weight.sum() + PRIOR_WEIGHT))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
        rows: int = TRAIN_ROWS) -> Examples:
    """The examples of a sample of about `rows` labelled rows.

    Null labels and ids are left out; an id, or a text, with several labels takes the rounded mean. Equal texts are one
    example. Terms are counted in Spark; the driver gets the terms and the sample's packed term lists, never texts.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
        .groupBy(F.col(id).cast("long").alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    )
    sample = bounded_sample(known, "id", rows, SEED)
    chosen = (
        docs.select(F.col(id).cast("long").alias("id"), text_of(text).alias("text"))
        .join(F.broadcast(sample), "id")
        .groupBy("text").agg(F.min("id").alias("id"), (F.avg("label") >= 0.5).cast("int").alias("label"))
        .select("id", "label", "text")
    )
    chosen = durable(chosen)
    totals = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    no, yes = totals.get(0, 0), totals.get(1, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = TermReader(None)
        for batch in batches:
            for part in text_slices(batch, 2):
                marks = part.column(1).to_numpy()
                found = [t for t, _ in reader.counts(part.column(2).to_pylist())]
                terms = np.concatenate([np.zeros(0, np.int64), *found])
                sizes = [len(f) for f in found]
                distinct, place = np.unique(terms, return_inverse=True)
                toxic = np.bincount(place[np.repeat(marks, sizes) == 1], minlength=len(distinct))
                sums = [pa.array(np.bincount(place, minlength=len(distinct))), pa.array(toxic)]
                yield pa.RecordBatch.from_arrays([pa.array(distinct), *sums], names=["term", "texts", "toxic"])

    counts = chosen.mapInArrow(tidy(count), "term long, texts long, toxic long").groupBy("term").agg(
        F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic")
    )
    p, q = (F.col("toxic") + 0.5) / (yes + 1.0), (F.col("texts") - F.col("toxic") + 0.5) / (no + 1.0)
    z = F.abs(p - q) / F.sqrt(p / (yes + 1.0) + q / (no + 1.0))
    told = counts.select("term", "texts", z.alias("z")).toArrow()
    vocabulary, texts, sure = (told.column(c).to_numpy() for c in ("term", "texts", "z"))
    del told
    worth = np.log(1 + (no + yes + 1) / (texts + 1.0)) * np.maximum(LEAST_WORTH, np.minimum(1, sure / SURE_Z) ** 4)
    order = np.argsort(vocabulary)
    vocabulary, worth = vocabulary[order], worth[order]
    del texts, sure, order
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = TermReader(sent.value)
        for batch in batches:
            for part in text_slices(batch, 2):
                found = pa.array([_packed(*f) for f in reader.counts(part.column(2).to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], names=["id", "label", "terms"])

    packed = chosen.mapInArrow(tidy(read), "id long, label int, terms binary").toArrow()
    sent.destroy()
    return Examples(vocabulary, worth, packed)


def score_texts(texts: list[str], search: Search, reader: TermReader) -> list[tuple[float, list[tuple]]]:
    """For each text its score and evidence."""
    index = search.index
    out = [(vote(index, np.zeros(0, np.int64), np.zeros(0)), [])] * len(texts)
    held: list[tuple[int, tuple[np.ndarray, np.ndarray]]] = []

    def score() -> None:
        for (i, _), (e, s) in zip(held, search.nearest([t for _, t in held], NEIGHBOURS)):
            share = index.positives[e] / index.examples[e]
            shown = zip(index.ids[e[:EVIDENCE]].tolist(), s[:EVIDENCE].tolist(), share[:EVIDENCE].tolist())
            out[i] = (vote(index, e, s), list(shown))
        held.clear()

    for i, (places, counts) in enumerate(reader.counts(texts)):
        if len(places):
            held.append((i, (places, vector(places, np.minimum(counts, 4), index.worth))))
        if len(held) == BATCH:
            score()
    score()
    return out


def scored(docs: DataFrame, index: Examples, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), evidence (example id, cosine, toxic share).

    The whole text counts. A text without any term of the vocabulary, such as a null or empty one,
    gets the share of toxic examples among those without a term, and no evidence; without any
    examples the score is 0.5. Ids may be null or repeat; other columns are not read; an empty table
    gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(index)
    names = ("doc_id", "cosine", "toxic")
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(sent.value.entries())
        reader = TermReader(search.index.vocabulary)
        for batch in batches:
            for part in text_slices(batch, 1):
                out = score_texts(part.column(1).to_pylist(), search, reader)
                shown = [[dict(zip(names, x)) for x in o[1]] for o in out]
                columns = [part.column(0), pa.array([o[0] for o in out], pa.float64()), pa.array(shown, evidence)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "evidence"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(
        tidy(run), "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:double>>"
    )


def without_toxic(docs: DataFrame, index: Examples, text: str = "text", limit: float = REJECTED) -> DataFrame:
    """The rows of `docs` whose text scores below `limit`, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = Search(sent.value.entries())
        reader = TermReader(search.index.vocabulary)
        for texts in parts:
            block = texts.str.len().cumsum() // BLOCK_BYTES
            found = [o[0] for _, run in texts.groupby(block) for o in score_texts(run.tolist(), search, reader)]
            yield pd.Series(found, dtype="float64")

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from tidy(scores)(parts)

    return docs.where(score(text_of(text)) < limit)
