"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A word gives a token for its letters and a token for its shape (case and the marks around it).
Features are hashes of words, shapes and their n-grams; a feature's value is its share of the
text's words. Scores are sparse dot products, so texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.llm.common import bounded_sample, coded, hashes, mix64, text_of, text_rows, text_slices, tidy

BITS = 18
TRAIN_ROWS = 16_000  # bound of the labelled sample
SHARDS = 8  # each is trained on its own, then weights are averaged
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.002, 0.01
SCALE = 10.0  # of feature values
SEED = 11
BIAS = 0  # the feature that every text has

_ODD = np.random.default_rng(99).integers(1, 2**63, 8, dtype=np.uint64) * 2 + 1


@lru_cache(maxsize=100_000)
def _tokens(word: str) -> tuple[str, str]:
    core = word.strip("".join(c for c in set(word) if not c.isalnum()))
    start = word.find(core) if core else 0
    case = "A" if len(core) > 1 and core.isupper() else "a" if core.isalpha() else "0" if core else ""
    return core.lower(), f"{word[:start]}{case}{word[start + len(core):]}"[:16]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words of all texts, five per word (one row each), and words per text.

    The five are word, pair of words, shape, pair of shapes and triple of shapes, each ending at that
    word; a word that repeats the one before has a pair of its own kind.
    """
    split = [t.split() for t in texts]
    lengths = np.array([len(w) for w in split], np.int64)
    codes, distinct = coded([w for ws in split for w in ws])
    if not distinct:
        return np.zeros((0, 5), np.int64), lengths
    cores, shapes = zip(*map(_tokens, distinct))
    word, shape = hashes(cores)[codes], hashes(shapes, 1)[codes]
    first = np.zeros(len(codes), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    second = np.roll(first, 1) & ~first
    start = np.uint64(1)

    def before(x, edge):
        return np.where(edge, start, np.roll(x, 1))

    last_word, last_shape = before(word, first), before(shape, first)
    last_two = np.where(first | second, start, np.roll(shape, 2))
    pair = np.where(last_word == word, _ODD[0], mix64(word * _ODD[1] + last_word * _ODD[2]))
    shape_pair = mix64(shape * _ODD[3] + last_shape * _ODD[4])
    triple = mix64(shape_pair * _ODD[5] + last_two * _ODD[6])
    found = np.stack([mix64(word), pair, mix64(shape), shape_pair, triple], axis=1)
    return (found % np.uint64((1 << BITS) - 1)).astype(np.int64) + 1, lengths


def train_shard(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """Weights after EPOCHS passes of per-coordinate FTRL updates, text by text in the given order."""
    found, lengths = features(texts)
    ends = np.cumsum(lengths)
    examples = []
    for a, b in zip(ends - lengths, ends):
        index, counts = np.unique(found[a:b], return_counts=True)
        value = np.append(1.0, SCALE * counts / max(1, b - a))
        examples.append((np.append(BIAS, index).astype(np.int32), value.astype(np.float32)))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(EPOCHS):
        for (index, value), label in zip(examples, labels):
            w = _weights(z[index], n[index])
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            step = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - step * w
            n[index] += g * g
    return _weights(z, n)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = TRAIN_ROWS, shards: int = SHARDS) -> np.ndarray:
    """Weights from a sample of about `rows` labelled rows; zeros if there is none.

    `labels` holds the rows that may be learned from; null labels and ids are left out, and an id with
    several labels takes the rounded mean. SHARDS groups are trained apart in tasks and averaged; the driver
    gets one vector of 2**BITS weights.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
        .groupBy(F.col(id).alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    )
    sample = bounded_sample(known, "id", rows, SEED)
    chosen = docs.select(F.col(id).alias("id"), text_of(text).alias("text")).join(F.broadcast(sample), "id")
    order = F.xxhash64(F.col("id").cast("string"), F.lit(SEED + 1))
    chosen = chosen.withColumn("order", order).withColumn("shard", F.pmod("order", F.lit(shards)))

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["order", "text"])
        w = train_shard(group["text"].tolist(), group["label"].to_numpy())
        index = np.flatnonzero(w)
        return pd.DataFrame({"place": index, "weight": w[index]})

    trained = chosen.groupBy("shard").applyInPandas(train, "place int, weight double")
    weights = np.zeros(1 << BITS)
    found = trained.groupBy("place").agg(F.sum("weight").alias("weight")).toPandas()
    weights[found["place"].to_numpy()] = found["weight"].to_numpy() / min(shards, max(1, sample.count()))
    return weights.round(9)


def score_texts(texts: list[str], weights: np.ndarray) -> np.ndarray:
    found, lengths = features(texts)
    per_word = np.append(weights[found].sum(axis=1), 0.0)
    ends = np.cumsum(lengths)
    sums = np.add.reduceat(per_word, np.minimum(ends - lengths, len(per_word) - 1))[: len(texts)] if len(texts) else np.zeros(0)
    sums = np.where(lengths > 0, sums, 0.0)
    return 1 / (1 + np.exp(-np.clip(weights[BIAS] + SCALE * sums / np.maximum(lengths, 1), -35, 35)))


def scored(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1; higher: label 1 is likelier).

    The whole text counts. Null, empty and blank texts get the score of the bias alone, 0.5 without any
    labels. Ids may be null or repeat; other columns are not read; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1):
                scores = score_texts(part.column(1).to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return text_rows(rows).mapInArrow(tidy(run), "doc_id long, score double")
