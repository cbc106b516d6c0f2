"""Angular-margin classification head: logits, loss, accuracy, prediction.

Class weights are a table `(class BIGINT, w ARRAY)` with classes 0..C-1, one row per class.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshelf.constants import BATCH_SIZE, MARGIN, MARGIN_SCALE, SEED
from vecshelf.functions.text import hash_number
from vecshelf.functions.vectors import DOUBLES, from_matrix, to_matrix, unit_rows
from vecshelf.operators.batching import batches
from vecshelf.session import durable

MAX_CLASSES = 100_000
MAX_WEIGHTS = 128 * 1024 * 1024


def class_matrix(weights: DataFrame) -> np.ndarray:
    """The class weights as a driver-side matrix `[classes, dim]`; its size is checked first."""
    size = weights.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("w")).alias("dim")).first()
    if size["n"] > MAX_CLASSES or size["n"] * (size["dim"] or 0) > MAX_WEIGHTS:
        raise ValueError(f"class table too large for the driver: {size.asDict()}")
    rows = weights.orderBy("class").collect()
    if [r["class"] for r in rows] != list(range(len(rows))):
        raise ValueError("classes must be 0..C-1, each once")
    return np.array([r["w"] for r in rows], dtype=np.float64)


def unit_classes(matrix: np.ndarray, norm_axis: str = "class") -> np.ndarray:
    """Normalise each class vector, or each feature over the classes (`norm_axis="feature"`)."""
    if norm_axis == "class":
        return unit_rows(matrix)
    if norm_axis == "feature":
        return unit_rows(matrix.T).T
    raise ValueError(norm_axis)


def margin_terms(
    cos: np.ndarray, m: float = MARGIN, easy: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """cos(angle + m) with its continuation past the turning point, and its slope in cos."""
    sin = np.sqrt(np.clip(1.0 - cos * cos, 0.0, 1.0))
    moved = cos * math.cos(m) - sin * math.sin(m)
    slope = math.cos(m) + math.sin(m) * cos / np.maximum(sin, 1e-7)
    inside = cos > 0 if easy else cos > math.cos(math.pi - m)
    beyond = cos if easy else cos - m * math.sin(math.pi - m)
    return np.where(inside, moved, beyond), np.where(inside, slope, 1.0)


def cosine_logits(
    df: DataFrame,
    weights: DataFrame | np.ndarray,
    embedding: str = "embedding",
    out: str = "logits",
    norm_axis: str = "class",
) -> DataFrame:
    """Test-mode logits: the cosine to every class, without scale or margin."""
    unit = unit_classes(_matrix(weights), norm_axis).T

    @F.arrow_udf(DOUBLES)
    def logits(v: pa.Array) -> pa.Array:
        x = to_matrix(v)
        return from_matrix(unit_rows(x) @ unit if len(x) else np.zeros((0, unit.shape[1])))

    return df.withColumn(out, logits(F.col(embedding)))


def arc_logits(
    df: DataFrame,
    weights: DataFrame | np.ndarray,
    label: str = "label",
    embedding: str = "embedding",
    s: float = MARGIN_SCALE,
    m: float = MARGIN,
    easy: bool = False,
    norm_axis: str = "class",
    out: str = "logits",
) -> DataFrame:
    """Training logits: the label's cosine gets the angular margin, all are scaled by `s`."""
    unit = unit_classes(_matrix(weights), norm_axis).T

    @F.arrow_udf(DOUBLES)
    def logits(v: pa.Array, labels: pa.Array) -> pa.Array:
        x = to_matrix(v)
        cos = unit_rows(x) @ unit if len(x) else np.zeros((0, unit.shape[1]))
        row = np.arange(len(cos))
        target = label_index(labels, unit.shape[1])
        cos[row, target] = margin_terms(cos[row, target], m, easy)[0]
        return from_matrix(cos * s)

    return df.withColumn(out, logits(F.col(embedding), F.col(label)))


def label_index(labels: pa.Array, n_classes: int) -> np.ndarray:
    if labels.null_count:
        raise ValueError("null label")
    index = labels.to_numpy(zero_copy_only=False).astype(np.int64)
    if len(index) and (index.min() < 0 or index.max() >= n_classes):
        raise ValueError(f"label outside 0..{n_classes - 1}")
    return index


def _matrix(weights: DataFrame | np.ndarray) -> np.ndarray:
    return class_matrix(weights) if isinstance(weights, DataFrame) else np.asarray(weights)


def loss_of(logits: str, label: str, scale: float = 1.0) -> Column:
    """Softmax cross-entropy of one row, by log-sum-exp."""
    top = F.array_max(logits) * scale
    total = F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z * scale - top))
    return F.log(total) + top - F.element_at(logits, (F.col(label) + 1).cast("int")) * scale


def top_class(logits: str) -> Column:
    """The class with the largest logit; of equals, the lowest."""
    return F.array_position(logits, F.array_max(logits)) - 1


def cross_entropy(
    df: DataFrame, logits: str = "logits", label: str = "label", out: str = "loss"
) -> DataFrame:
    return df.withColumn(out, loss_of(logits, label))


def accuracy(df: DataFrame, logits: str = "logits", label: str = "label") -> DataFrame:
    """One row: the share of rows whose top class is the label."""
    hit = (top_class(logits) == F.col(label)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def predict(
    df: DataFrame,
    weights: DataFrame | np.ndarray,
    embedding: str = "embedding",
    out: str = "predicted",
    norm_axis: str = "class",
) -> DataFrame:
    scored = cosine_logits(df, weights, embedding, "_logits", norm_axis)
    return scored.withColumn(out, top_class("_logits")).drop("_logits")


def evaluate(
    df: DataFrame,
    weights: DataFrame | np.ndarray,
    id: str,
    embedding: str = "embedding",
    label: str = "label",
    batch_size: int = BATCH_SIZE,
    s: float = MARGIN_SCALE,
    norm_axis: str = "class",
) -> DataFrame:
    """One row: number of rows, losses and accuracy in test mode.

    `loss_batch_mean` is the mean over batches (in `id` order) of the batch's mean loss on plain
    cosines; `loss_row_mean` weighs rows equally; `loss_scaled` uses cosines times `s`.
    """
    scored = cosine_logits(df.select(id, embedding, label), weights, embedding, "_z", norm_axis)
    rows = scored.select(
        id,
        loss_of("_z", label).alias("loss"),
        loss_of("_z", label, s).alias("scaled"),
        (top_class("_z") == F.col(label)).cast("double").alias("hit"),
    )
    # Written first: ordering the rows reads them twice, and scoring is the costly part.
    per_batch = batches(durable(rows), id, batch_size).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("loss").alias("mean_loss"),
        F.sum("loss").alias("loss"),
        F.sum("scaled").alias("scaled"),
        F.sum("hit").alias("hits"),
    )
    n = F.sum("n")
    return per_batch.agg(
        n.alias("n"),
        F.avg("mean_loss").alias("loss_batch_mean"),
        (F.sum("loss") / n).alias("loss_row_mean"),
        (F.sum("scaled") / n).alias("loss_scaled"),
        (F.sum("hits") / n).alias("accuracy"),
    )


def class_centroids(
    df: DataFrame, embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """Class weights from data: the mean vector of each label, summed before the shuffle."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(embedding))))
    return df.groupBy(F.col(label).cast("bigint").alias("class")).agg(mean.alias("w"))


def initial_weights(classes: DataFrame, dim: int, seed: int = SEED) -> DataFrame:
    """Kaiming-uniform weights for a `(class)` table, each a function of (seed, class, position)."""
    limit = math.sqrt(6.0 / dim)

    def draw(place: Column) -> Column:
        unit = hash_number(F.lit(seed), F.col("class"), place) / F.lit(float(2**32))
        return (unit * 2.0 - 1.0) * limit

    places = F.sequence(F.lit(0), F.lit(dim - 1))
    return classes.select(
        F.col("class").cast("bigint").alias("class"), F.transform(places, draw).alias("w")
    )
