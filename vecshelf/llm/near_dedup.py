"""Near-duplicates by an LSH forest: sorted signature orders and longest-common-prefix neighbours.

Every distinct shingle set gets ORDERS labels of DEPTH MinHash values each and a small sketch. In each
order the labels are range-sorted; sets that share a prefix with a neighbour are candidates. How
long a prefix must be adapts to the region: where many sets share a prefix, longer ones are asked
for. Crowded regions also name hubs, the sets nearest to the region's commonest MinHash values, and
all their members are candidates with those: copies of one original are, though they may be too unlike
each other. Candidates are confirmed on full sets, best first: a pair inside a class that is already
linked needs no check, so large groups of copies cost a few pairs per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecshelf.llm.common import coded, hashes, mix64, small_side, text_of, text_rows, text_slices, tidy
from vecshelf.llm.components import components
from vecshelf.session import durable

ORDERS, DEPTH = 16, 8
FIRST_DEPTH = 3  # two sets with similarity s share a prefix of d values in one order with chance s ** d
REGION = 8  # sets that a region may hold before a longer prefix is asked for
NEAREST = 2  # neighbours on each side that are candidates in any region
SCAN_ROWS = 10_000  # of an order that a task looks at side by side
HUB_DEPTHS = (3, 5, 8)  # prefix lengths whose crowded regions name hubs
HUBS = 3  # of a region
HUBS_SENT = 100_000  # hubs that a broadcast may hold, at some 120 bytes each
SKETCH = ORDERS * DEPTH // 2  # bytes: four bits of each MinHash value
LEAST_ESTIMATE = 0.17  # below the wanted similarity, 5 standard errors of the sketch
ROUNDS = 3  # of best-partner confirmation, before all pairs that are left

_MULTIPLIERS = np.random.default_rng(20_240_501).integers(1, 2**63, ORDERS * DEPTH, dtype=np.uint64) * 2 + 1
_PLACES = np.random.default_rng(7_777).integers(1, 2**63, 64, dtype=np.uint64) * 2 + 1
_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, labels binary, sketch binary"


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles; a text of fewer words is one shingle.

    Words are what ASCII white space parts, with A-Z in lower case; no words give no shingles.
    """
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    codes, distinct = coded([w for ws in split for w in ws])
    values = hashes(distinct)[codes] if distinct else np.zeros(0, np.uint64)
    n = max(0, len(values) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(words):
        rolled += values[i : i + n] * _PLACES[i]
    rolled = mix64(rolled)
    at = 0
    for ws in split:
        if len(ws) >= words:
            yield np.unique(rolled[at : at + len(ws) - words + 1])
        elif ws:
            short = (values[at : at + len(ws)] * _PLACES[: len(ws)]).sum(dtype=np.uint64)
            yield mix64(np.array([short + np.uint64(len(ws))], np.uint64) ^ _PLACES[-1])
        else:
            yield np.zeros(0, np.uint64)
        at += len(ws)


def signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """The labels of all orders (two bytes a level) and the sketch."""
    least = np.full(ORDERS * DEPTH, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        least = np.minimum(least, np.multiply.outer(shingles[at : at + 1024], _MULTIPLIERS).min(axis=0))
    spread = mix64(least)
    nibbles = ((spread >> np.uint64(32)) & np.uint64(15)).astype(np.uint8)
    return (spread & np.uint64(0xFFFF)).astype(">u2").tobytes(), (nibbles[::2] << 4 | nibbles[1::2]).tobytes()


def _signed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1):
                rows = [(0, 0, 0, b"", b"")] * part.num_rows
                for i, s in enumerate(shingle_sets(part.column(1).to_pylist(), words)):
                    if len(s):
                        sums = np.array([mix64(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s + np.uint64(1)))])
                        rows[i] = (len(s), *sums.view(np.int64).tolist(), *signature(s))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns], names=["doc_id", "n_shingles", "set_a", "set_b", "labels", "sketch"]
                )

    return run


def estimates(sketches: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of sets by their sketches, row by row."""
    differ = sketches ^ others
    equal = ((differ & 0xF0) == 0).sum(axis=1) + ((differ & 0x0F) == 0).sum(axis=1)
    return (equal / (2 * SKETCH) - 1 / 16) * 16 / 15


def neighbours(
    order: np.ndarray, labels: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs among rows sorted by (order, label): positions i < j, and estimates in per mille.

    Only pairs whose sizes rule out the similarity, or whose sketches speak clearly against it, go.
    """
    n = len(order)
    shared = shared_prefixes(order, labels)
    depth = np.full(n, DEPTH + 1)
    for d in range(DEPTH, FIRST_DEPTH - 1, -1):
        region = np.cumsum(shared < d)
        depth[np.bincount(region)[region] <= REGION] = d
    found_i, found_j, found_e = [], [], []
    prefix = shared  # of each row and the row `lag` before it, from row `lag` on
    for lag in range(1, REGION):
        prefix = shared[1:] if lag == 1 else np.minimum(prefix[1:], shared[1 : n - lag + 1])
        j = np.arange(lag, n)
        wanted = prefix >= (FIRST_DEPTH if lag <= NEAREST else depth[lag:])
        low, high = np.minimum(sizes[lag:], sizes[:-lag]), np.maximum(sizes[lag:], sizes[:-lag])
        j = j[wanted & (low >= similarity * high - 1e-9)]
        if not len(j):
            continue
        estimate = estimates(sketches[j], sketches[j - lag])
        near = estimate >= similarity - LEAST_ESTIMATE
        found_i.append(j[near] - lag)
        found_j.append(j[near])
        found_e.append((estimate[near] * 1000).astype(np.int32))
    if not found_i:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(found_i), np.concatenate(found_j), np.concatenate(found_e)


_PAIR = "a long, b long, estimate int"
_PAIRS = _PAIR + ", gap int, score int, order int, label binary, rid long, n long, sketch binary"
_CONTEXT = 2 * REGION  # rows on either side that decide a row's region and neighbours


def shared_prefixes(order: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How many values each row's label shares with that of the row before."""
    same = np.logical_and.accumulate(labels[1:] == labels[:-1], axis=1).sum(axis=1) * (order[1:] == order[:-1])
    return np.concatenate([[0], same])


def _matrices(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    labels = np.frombuffer(b"".join(rows["label"]), np.uint8).reshape(len(rows), DEPTH, 2)
    sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), SKETCH)
    return labels[:, :, 0].astype(np.int32) * 256 + labels[:, :, 1], sketches


def _hubs_of(rows: pd.DataFrame) -> pd.DataFrame:
    """The HUBS sets of each crowded region that agree most with the region's commonest values."""
    labels, sketches = _matrices(rows)
    shared = shared_prefixes(rows["order"].to_numpy(), labels)
    values = np.stack([sketches >> 4, sketches & 15], axis=2).reshape(len(rows), 2 * SKETCH)
    at, scores, depths = [], [], []
    for d in HUB_DEPTHS:
        begins = np.append(np.flatnonzero((shared < d) | (np.arange(len(rows)) == 0)), len(rows))
        for a, b in zip(begins, begins[1:]):
            if b - a <= REGION:
                continue
            own = values[a:b]
            counts = np.stack([(own == v).sum(axis=0) for v in range(16)])
            agree = (own == counts.argmax(axis=0)).sum(axis=1)
            best = np.argsort(-agree, kind="stable")[:HUBS]
            at.append(a + best)
            scores.append(agree[best])
            depths += [d] * len(best)
    if not at:
        return rows.head(0).assign(score=0)
    found = rows.iloc[np.concatenate(at)].reset_index(drop=True)
    found["score"] = np.concatenate(scores).astype(np.int32)
    found["label"] = [label[: 2 * d] for label, d in zip(found["label"], depths)]
    return found


def _with_hubs(similarity: float):
    """Candidates of members and hubs that come side by side."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            low, high = np.minimum(rows["n"], rows["hub_n"]), np.maximum(rows["n"], rows["hub_n"])
            rows = rows[(low >= similarity * high - 1e-9) & (rows["rid"] != rows["hub"])]
            if not len(rows):
                continue
            own, theirs = (
                np.frombuffer(b"".join(rows[c]), np.uint8).reshape(len(rows), SKETCH) for c in ("sketch", "hub_sketch")
            )
            estimate = estimates(own, theirs)
            near = estimate >= similarity - LEAST_ESTIMATE
            a, b = rows["rid"].to_numpy()[near], rows["hub"].to_numpy()[near]
            yield pd.DataFrame(
                {"a": np.minimum(a, b), "b": np.maximum(a, b), "estimate": (estimate[near] * 1000).astype(np.int32)}
            )

    return run


def _pairs_of(rows: pd.DataFrame, similarity: float, fresh: int = 0) -> pd.DataFrame:
    """Candidates among sorted rows, without those of the first `fresh` rows among themselves."""
    labels, sketches = _matrices(rows)
    i, j, estimate = neighbours(rows["order"].to_numpy(), labels, rows["n"].to_numpy(), sketches, similarity)
    new = j >= fresh
    ids = rows["rid"].to_numpy()
    left, right = ids[i[new]], ids[j[new]]
    return pd.DataFrame(
        {"a": np.minimum(left, right), "b": np.maximum(left, right), "estimate": estimate[new].astype(np.int32)}
    )


def _gathered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of small frames in frames of some SCAN_ROWS rows."""
    held, n = [], 0
    for rows in parts:
        held.append(rows)
        n += len(rows)
        if n >= SCAN_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def _scan(similarity: float):
    """Candidates and hubs within a sorted partition; its first and last rows come out too, for `_stitch`."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partition, held, first = TaskContext.get().partitionId(), None, True
        for rows in _gathered(parts):
            if first:
                yield rows.head(_CONTEXT).assign(gap=partition)
                first = False
            old = 0 if held is None else len(held)
            held = rows if held is None else pd.concat([held, rows], ignore_index=True)
            # Rows before the context of the last batch have seen all their neighbours.
            yield _pairs_of(held, similarity, max(0, old - REGION))
            yield _hubs_of(held)
            held = held.tail(_CONTEXT).reset_index(drop=True)
        if held is not None:
            yield held.assign(gap=partition + 1)

    def whole(parts):
        for out in run(parts):
            yield out.reindex(columns=[c.split()[0] for c in _PAIRS.split(", ")]).astype(
                {c: "Int64" for c in ("a", "b", "rid", "n")} | {c: "Int32" for c in ("estimate", "gap", "score", "order")}
            )

    return whole


def _stitch(similarity: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "label", "rid"], ignore_index=True)
        return _pairs_of(rows, similarity)

    return run


def candidates(sets: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (a, b, estimate), each once, of a table (rid, n, labels, sketch). A written table."""
    width = 2 * DEPTH
    labels = F.array(*[F.substring("labels", i * width + 1, width) for i in range(ORDERS)])
    rows = sets.select(F.posexplode(labels).alias("order", "label"), "rid", "n", "sketch")
    placed = rows.repartitionByRange("order", "label", "rid").sortWithinPartitions("order", "label", "rid")
    scanned = durable(placed.mapInPandas(tidy(_scan(similarity)), _PAIRS))
    ends = scanned.where("gap is not null").select("gap", "order", "label", "rid", "n", "sketch")
    joined = ends.groupBy("gap").applyInPandas(_stitch(similarity), _PAIR)
    # A region may lie in several partitions: of the hubs named there, those that agree most stay.
    best = Window.partitionBy("order", "label").orderBy(F.desc("score"), "rid")
    named = scanned.where("score is not null").select("order", "label", "rid", "n", "sketch", "score").distinct()
    hubs = durable(
        named.withColumn("place", F.row_number().over(best)).where(F.col("place") <= HUBS)
        .select("order", "label", F.col("rid").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
    )
    prefixes = F.array(*[F.substring("label", 1, 2 * d) for d in HUB_DEPTHS])
    members = rows.select("order", F.explode(prefixes).alias("label"), "rid", "n", "sketch")
    beside = members.join(small_side(hubs, HUBS_SENT), ["order", "label"]).select(
        "rid", "n", "sketch", "hub", "hub_n", "hub_sketch"
    )
    pairs = scanned.where("a is not null").select("a", "b", "estimate").union(joined)
    pairs = pairs.union(beside.mapInPandas(_with_hubs(similarity), _PAIR)).where("a != b")
    return durable(pairs.groupBy("a", "b").agg(F.max("estimate").alias("estimate")))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    fits = 100 * common >= percent * (F.size("sa") + F.size("sb") - common)
    return durable(both.where(fits).select("a", "b"))


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1):
                found = list(shingle_sets(part.column(1).to_pylist(), words))
                key = [int(mix64(s).sum(dtype=np.uint64).view(np.int64)) for s in found]
                columns = [part.column(0), pa.array(key), pa.array([s.view(np.int64) for s in found])]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "set_a", "shingles"])

    return run


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Classes (node, component) of the sets that confirmed candidate pairs link.

    In each of the first rounds every set offers its most promising open partner; pairs inside a
    class that is linked by then are settled. The last round confirms every pair still open.
    """
    classes, links = None, None
    for round_ in range(ROUNDS + 1):
        open_ = pairs
        if classes is not None:
            ends = (classes.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
            for x, end in zip("ab", ends):
                open_ = open_.join(end, x, "left")
            open_ = open_.where("coalesce(ca, a) != coalesce(cb, b)").select("a", "b", "estimate")
        open_ = durable(open_)
        chosen = open_.select("a", "b")
        if round_ < ROUNDS:
            offers = open_.select(F.col("a").alias("node"), F.col("b").alias("other"), "estimate").union(
                open_.select(F.col("b").alias("node"), F.col("a").alias("other"), "estimate")
            )
            best = offers.groupBy("node").agg(F.max(F.struct("estimate", "other"))["other"].alias("other"))
            chosen = best.select(
                F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
            ).distinct()
            chosen = durable(chosen)
            pairs = open_.join(chosen, ["a", "b"], "left_anti")
        sure = _confirmed(chosen, sets, percent)
        links = sure if links is None else links.union(sure)
        classes = durable(components(links))
    return classes


def near_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are linked if 100 * |A and B| >= percent * |A or B| for their sets of distinct shingles of
    `words` words; a text of fewer words is one shingle, and a null, empty or blank text is linked
    with nothing. `component_id` is the smallest id reachable by links. Ids are integers; a null id
    shows null, kept. Rows that repeat an id and text show the same values; an id with several
    texts is linked through one of them. Equal sets are searched once. Other columns are not read; an
    empty table gives an empty result.
    """
    ids = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    signed = durable(text_rows(ids).mapInArrow(tidy(_signed(words)), _SIGNED))
    full = signed.where("n_shingles > 0")
    key = ["set_a", "set_b", "n_shingles"]
    first = full.where("doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rid"))
    first = durable(first)
    own = full.join(first.withColumn("doc_id", F.col("rid")), ["doc_id", *key], "left_semi")
    # An id that repeats with other texts stands for one of its sets, the same in every run.
    sets = durable(
        own.groupBy(F.col("doc_id").alias("rid"))
        .agg(F.min(F.struct(*key, "labels", "sketch")).alias("s"))
        .select("rid", F.col("s.n_shingles").alias("n"), "s.set_a", "s.labels", "s.sketch")
    )
    pairs = candidates(sets, percent / 100)
    used = durable(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    shingles = (
        ids.join(small_side(used), "doc_id", "left_semi")
        .mapInArrow(tidy(_full_sets(words)), "rid long, set_a long, shingles array<long>")
    )
    shingles = durable(shingles.join(sets.select("rid", "set_a"), ["rid", "set_a"], "left_semi").dropDuplicates(["rid"]))
    classes = linked(pairs, shingles, percent)
    # A class's smallest set representative is its smallest document: representatives are smallest ids.
    rows = signed.select("doc_id", *key).join(first, key, "left")
    rows = rows.join(classes.select(F.col("node").alias("rid"), "component"), "rid", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rid", "doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def without_near_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one document of each group, the smallest id."""
    groups = near_groups(docs, id, text, words, percent)
    gone = durable(groups.where("not kept").select(F.col("doc_id").alias(id)).distinct())
    return docs.join(small_side(gone), id, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
