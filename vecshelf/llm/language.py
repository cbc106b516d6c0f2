"""Language ID of mixed text: script ranges, per-word letter statistics, and a Viterbi path over words.

Three-letter statistics of each language score every word; the word's script leaves only languages
that use it. A Viterbi path with a penalty for each change of language labels the words, and
runs of equal labels are spans.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import bounded_sample, text_of, text_rows, text_slices, tidy

BUCKETS = 1 << 16
TRAIN_ROWS = 16_000  # bound of the sample learned from
SMOOTHING = 0.5
SWITCH = 6.0  # nats that a change of language costs
SCRIPT_SHARE = 0.01  # of a language's letters, for the script to be one of its own
FAR = -1e6  # score of a language that does not use the word's script
UNKNOWN = "und"
SEED = 31
BLOCK_BYTES = 2 << 20

#: First code points of script ranges: fixed values, from the block table of the Unicode standard.
SCRIPTS = (
    ("latin", 0x0000), ("greek", 0x0370), ("cyrillic", 0x0400), ("armenian", 0x0530), ("hebrew", 0x0590),
    ("arabic", 0x0600), ("indic", 0x0900), ("thai", 0x0E00), ("tibetan", 0x0F00), ("georgian", 0x10A0),
    ("hangul", 0x1100), ("ethiopic", 0x1200), ("other", 0x1380), ("latin", 0x1E00), ("greek", 0x1F00),
    ("other", 0x2000), ("kana", 0x3040), ("other", 0x3130), ("han", 0x3400), ("other", 0xA000),
    ("hangul", 0xAC00), ("other", 0xD7B0), ("han", 0xF900), ("latin", 0xFB00), ("hebrew", 0xFB1D),
    ("arabic", 0xFB50), ("other", 0xFE00), ("arabic", 0xFE70), ("latin", 0xFF00), ("other", 0x10000),
    ("han", 0x20000), ("other", 0x32000),
)
_NAMES = sorted({name for name, _ in SCRIPTS})
_STARTS = np.array([start for _, start in SCRIPTS])
_KINDS = np.array([_NAMES.index(name) for name, _ in SCRIPTS])


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # [bucket, language]: log chance of three letters
    uses: np.ndarray  # [script, language]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case code point of each letter or mark, and 0 for everything else."""
    out = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha() or unicodedata.category(ch)[0] == "M":
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


class Words(NamedTuple):
    buckets: np.ndarray  # of every letter: the three letters around it
    starts: np.ndarray  # letter at which each word begins
    lengths: np.ndarray  # letters of each word
    places: np.ndarray  # code point in the joined texts at which each word begins
    per_text: np.ndarray  # words of each text
    scripts: np.ndarray  # of each letter


def read_words(texts: list[str]) -> Words:
    """Words, which are runs of letters, of texts that are each taken whole."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32)
    low = _letters()[points]
    at = np.flatnonzero(low)
    ends = np.cumsum([len(t) + 1 for t in texts])
    around = np.concatenate([[0], low, [0]]).astype(np.uint64)
    key = around[at] * np.uint64(0x9E3779B1) + around[at + 1] * np.uint64(0x85EBCA77) + around[at + 2] * np.uint64(0xC2B2AE3D)
    key = (key ^ (key >> np.uint64(15))) * np.uint64(0x27D4EB2F)
    buckets = ((key >> np.uint64(16)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1])) if len(at) else np.zeros(0, np.int64)
    places = at[starts]
    per_text = np.diff(np.concatenate([[0], np.searchsorted(places, ends)]))
    lengths = np.diff(np.concatenate([starts, [len(at)]]))
    scripts = _KINDS[np.searchsorted(_STARTS, low[at], side="right") - 1]
    return Words(buckets, starts, lengths, places, per_text, scripts)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """[word, language]: log chance of each word; far below for languages without the word's script."""
    if not len(words.starts):
        return np.zeros((0, len(model.languages)), np.float32)
    scores = np.add.reduceat(model.table[words.buckets], words.starts, axis=0)
    usable = model.uses[words.scripts[words.starts]]
    return scores + np.where(usable | ~usable.any(axis=1, keepdims=True), 0, FAR).astype(np.float32)


def viterbi(scores: np.ndarray, per_text: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word, texts side by side: step t reads word t of every text that has one."""
    n_words, n = scores.shape
    path = np.zeros(n_words, np.int32)
    if not n_words:
        return path
    begin = np.cumsum(per_text) - per_text
    order = np.argsort(-per_text, kind="stable")
    size = per_text[order]
    active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")  # texts longer than t
    value = scores[begin[order[: active[0]]]].astype(np.float64)
    came = np.zeros((n_words, n), bool)  # the language was changed just before this word
    best = np.zeros(n_words, np.int32)  # the language to have come from in that case
    for t in range(1, len(active)):
        rows = begin[order[: active[t]]] + t
        value[: active[t]] -= value[: active[t]].max(axis=1, keepdims=True)
        here = value[: active[t]]
        best[rows] = here.argmax(axis=1)
        changed = here < -switch
        came[rows] = changed
        value[: active[t]] = np.where(changed, -switch, here) + scores[rows]
    last = value.argmax(axis=1).astype(np.int32)
    now = np.zeros(len(order), np.int32)
    now[: len(last)] = last
    for t in range(len(active) - 1, -1, -1):
        rows = begin[order[: active[t]]] + t
        state = now[: active[t]]
        path[rows] = state
        now[: active[t]] = np.where(came[rows, state], best[rows], state)
    return path


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """Letter statistics from about `rows` rows of `docs`, all of which may be learned from.

    Rows with a null text, language or id teach nothing. Counting is done in Spark; the driver gets one
    table of BUCKETS counts and one of scripts per language.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(id).isNotNull())
    sample = bounded_sample(known.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")), "id", rows, SEED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1, BLOCK_BYTES):
                words = read_words(part.column(1).to_pylist())
                letters = np.repeat(np.repeat(np.arange(part.num_rows), words.per_text), words.lengths)
                langs, code = np.unique(np.array(part.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
                wide = BUCKETS + len(_NAMES)
                keys = np.concatenate(
                    [code[letters] * wide + words.buckets, code[letters] * wide + BUCKETS + words.scripts]
                )
                distinct, counts = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs[distinct // wide].tolist(), pa.string()), pa.array(distinct % wide), pa.array(counts)],
                    names=["lang", "place", "n"],
                )

    counted = text_rows(sample.select("lang", "text")).mapInArrow(tidy(count), "lang string, place long, n long")
    found = counted.groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    counts[found["place"], [languages.index(x) for x in found["lang"]]] = found["n"]
    letters, scripts = counts[:BUCKETS] + SMOOTHING, counts[BUCKETS:]
    table = np.log(letters / letters.sum(axis=0)).astype(np.float32)
    return Model(languages, table, scripts >= SCRIPT_SHARE * scripts.sum(axis=0).clip(1))


def label_texts(texts: list[str], model: Model, switch: float = SWITCH) -> list[tuple[str, float, list[tuple]]]:
    """For each text: language, share of its letters in that language, spans (start, end, language)."""
    if not model.languages:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    words = read_words(texts)
    path = viterbi(word_scores(words, model), words.per_text, switch)
    out, first, base = [], 0, 0
    for text, n in zip(texts, words.per_text):
        if not n:
            out.append((UNKNOWN, 0.0, []))
        else:
            own = path[first : first + n]
            letters = words.lengths[first : first + n]
            votes = np.bincount(own, letters, len(model.languages))
            edges = np.flatnonzero(np.diff(own)) + 1
            begins = np.concatenate([[0], edges])
            ends = np.concatenate([edges - 1, [n - 1]])
            place = words.places[first : first + n] - base
            # Letters of a word are adjacent code points, so its end is its begin and its length.
            spans = [
                (int(place[a]), int(place[b] + letters[b]), model.languages[own[a]]) for a, b in zip(begins, ends)
            ]
            out.append((model.languages[int(votes.argmax())], float(votes.max() / votes.sum()), spans))
        first += n
        base += len(text) + 1
    return out


def identified(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (share of letters in that language), spans.

    Spans are (start, end, lang) in code points of the whole text, in order. The language with most
    letters is predicted, ties to the first in code point order. A null text or one without a letter is
    `und` with score 0 and no spans, as is every text if nothing was learned. Ids may be null or
    repeat; other columns are not read; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ("start", "end", "lang")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1, BLOCK_BYTES):
                found = label_texts(part.column(1).to_pylist(), sent.value)
                shown = [[dict(zip(names, x)) for x in f[2]] for f in found]
                columns = [
                    part.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array(shown, spans),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "spans"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return text_rows(rows).mapInArrow(
        tidy(run), "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"
    )
