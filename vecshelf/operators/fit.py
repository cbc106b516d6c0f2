"""Fitting the margin head over a table of embeddings."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.constants import (
    DROPOUT,
    EPOCHS,
    EPS_NORM,
    LEARNING_RATE,
    LOG_EVERY,
    MARGIN,
    MARGIN_SCALE,
    N_CLASSES,
    SAVE_EVERY,
    SEED,
    WARMUP,
    WEIGHT_DECAY,
)
from vecshelf.functions.vectors import (
    DOUBLES,
    dropout_draw,
    dropout_rows,
    from_matrix,
    to_matrix,
    unit_rows,
)
from vecshelf.operators import head as H
from vecshelf.session import durable, owned

_PARTIAL = "class bigint, sums array<double>, loss double, hits bigint, n bigint"


def partial_sums(
    df: DataFrame,
    weights: np.ndarray,
    label: str,
    embedding: str,
    s: float,
    m: float,
    easy: bool,
    p_drop: float = 0.0,
) -> DataFrame:
    """Per class: the summed outer product of loss slope and unit input, plus loss, hits and rows.

    Each partition adds up its own rows and sends one row per class; these are summed on the
    executors with map-side combining. `n` is the number of all rows, on every class. `_draw` feeds dropout.
    """
    n_classes, dim = weights.shape
    unit = H.unit_classes(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_classes, dim))
        loss, hits, n = 0.0, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = to_matrix(batch.column("x"))
            if p_drop > 0.0:
                x = dropout_rows(x, batch.column("draw").to_numpy(zero_copy_only=False), p_drop)
            x = unit_rows(x)
            row = np.arange(len(x))
            y = H.label_index(batch.column("y"), n_classes)
            cos = x @ unit.T
            moved, slope = H.margin_terms(cos[row, y], m, easy)
            z = cos * s
            z[row, y] = moved * s
            top = z.max(axis=1, keepdims=True)
            e = np.exp(z - top)
            total = e.sum(axis=1, keepdims=True)
            loss += float((np.log(total[:, 0]) + top[:, 0] - z[row, y]).sum())
            hits += int((z.argmax(axis=1) == y).sum())
            n += len(x)
            g = s * e / total
            g[row, y] = (g[row, y] - s) * slope
            sums += g.T @ x
        if n:
            first = np.arange(n_classes) == 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(n_classes)),
                    from_matrix(sums),
                    pa.array(np.where(first, loss, 0.0)),
                    pa.array(np.where(first, hits, 0)),
                    pa.array(np.full(n_classes, n)),
                ],
                names=["class", "sums", "loss", "hits", "n"],
            )

    draw = F.col("_draw") if p_drop > 0.0 else F.lit(0).cast("bigint")
    parts = df.select(
        F.col(embedding).alias("x"), F.col(label).cast("bigint").alias("y"), draw.alias("draw")
    ).mapInArrow(run, _PARTIAL)
    return parts.groupBy("class").agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"),
        F.sum("loss").alias("loss"),
        F.sum("hits").alias("hits"),
        F.sum("n").alias("n"),
    )


def weight_slope(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Slope with respect to the unnormalised class vectors, given that for the unit ones."""
    norms = np.maximum(np.sqrt((weights * weights).sum(axis=1, keepdims=True)), EPS_NORM)
    unit = weights / norms
    return (sums - unit * (unit * sums).sum(axis=1, keepdims=True)) / norms


def grad_step(
    df: DataFrame,
    weights: DataFrame | np.ndarray,
    label: str = "label",
    embedding: str = "embedding",
    s: float = MARGIN_SCALE,
    m: float = MARGIN,
    easy: bool = False,
) -> DataFrame:
    """The mean loss gradient as a table `(class, dim, g)`."""
    matrix = H.class_matrix(weights) if isinstance(weights, DataFrame) else np.asarray(weights)
    sums = partial_sums(df, matrix, label, embedding, s, m, easy)

    @F.arrow_udf(DOUBLES)
    def slope(classes: pa.Array, a: pa.Array) -> pa.Array:
        index = classes.to_numpy(zero_copy_only=False)
        return from_matrix(weight_slope(matrix[index], to_matrix(a)))

    return (
        sums.select("class", "n", F.posexplode(slope(F.col("class"), F.col("sums"))))
        .select("class", F.col("pos").cast("bigint").alias("dim"), (F.col("col") / F.col("n")).alias("g"))
    )


@dataclass
class HeadState:
    """Weights with the optimizer's moments; what a checkpoint holds."""

    weights: np.ndarray
    step: int = 0
    first: np.ndarray | None = None
    second: np.ndarray | None = None

    def __post_init__(self):
        if self.first is None:
            self.first = np.zeros_like(self.weights)
        if self.second is None:
            self.second = np.zeros_like(self.weights)


def decays(name: str) -> bool:
    """Whether a parameter is subject to weight decay."""
    return not any(part in name for part in ("bias", "norm"))


def adamw(
    state: HeadState,
    grad: np.ndarray,
    rate: float,
    weight_decay: float = WEIGHT_DECAY,
    name: str = "classifier.weight",
    beta1: float = 0.9,
    beta2: float = 0.999,
    eps: float = 1e-8,
) -> HeadState:
    """One Adam update with decoupled weight decay."""
    step = state.step + 1
    first = beta1 * state.first + (1 - beta1) * grad
    second = beta2 * state.second + (1 - beta2) * grad * grad
    kept = state.weights * (1.0 - rate * weight_decay) if decays(name) else state.weights
    move = (first / (1 - beta1**step)) / (np.sqrt(second / (1 - beta2**step)) + eps)
    return HeadState(kept - rate * move, step, first, second)


def rate_at(step: int, total: int, base: float = LEARNING_RATE, warmup: float = WARMUP) -> float:
    """Linear warm-up over the first share of steps, then linear decay to zero."""
    warm = int(warmup * total)
    if step < warm:
        return base * step / max(warm, 1)
    return base * max(0.0, (total - step) / max(total - warm, 1))


@dataclass
class ArcHeadModel:
    state: HeadState
    history: list[dict] = field(default_factory=list)

    @property
    def weights(self) -> np.ndarray:
        return self.state.weights

    def weight_table(self, spark: SparkSession) -> DataFrame:
        rows = [(j, [float(v) for v in w]) for j, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, "class bigint, w array<double>")

    def history_table(self, spark: SparkSession) -> DataFrame:
        columns = "step bigint, epoch bigint, batch bigint, loss double, accuracy double, steps_per_s double, dev_loss double, dev_accuracy double, rate double"
        names = [c.split()[0] for c in columns.split(",")]
        return spark.createDataFrame([tuple(h.get(n) for n in names) for h in self.history], columns)

    def transform(self, df: DataFrame, embedding: str = "embedding") -> DataFrame:
        return H.predict(df, self.weights, embedding)


@dataclass
class ArcHead:
    """Estimator for the class weights: one Spark job per step, full batch or hashed sub-batches.

    The driver holds class weights and their moments only (`n_classes x dim`).
    """

    n_classes: int = N_CLASSES
    dim: int = 1024
    s: float = MARGIN_SCALE
    m: float = MARGIN
    easy: bool = False
    epochs: int = EPOCHS
    lr: float = LEARNING_RATE
    weight_decay: float = WEIGHT_DECAY
    warmup: float = WARMUP
    dropout: float = DROPOUT
    sub_batches: int = 1
    seed: int = SEED
    log_every: int = LOG_EVERY
    save_every: int = SAVE_EVERY

    def fit(
        self,
        df: DataFrame,
        id: str = "id",
        embedding: str = "embedding",
        label: str = "label",
        init: HeadState | np.ndarray | None = None,
        dev: DataFrame | None = None,
        save_path: str | None = None,
        vocab: DataFrame | None = None,
    ) -> ArcHeadModel:
        """Fit; `init` continues a saved state. Every `save_every` steps: evaluate and save."""
        from vecshelf.sinks.heads import save_head

        spark = df.sparkSession
        state = self._start(spark, init)
        model = ArcHeadModel(state)
        total = self.epochs * self.sub_batches
        rows = df.select(id, embedding, label).persist()
        epoch_rows = contextlib.ExitStack()
        laid, laid_epoch = rows, -1
        try:
            seen = hits = 0
            clock, logged = time.monotonic(), state.step
            for step in range(state.step, total):
                epoch, batch = divmod(step, self.sub_batches)
                if self.sub_batches > 1 and epoch != laid_epoch:
                    # Each epoch deals its rows out once; a step then reads its own part only.
                    epoch_rows.close()
                    epoch_rows.enter_context(owned(spark))
                    turn = F.pmod(F.xxhash64(F.lit(self.seed), F.lit(epoch), F.col(id)), F.lit(self.sub_batches))
                    laid, laid_epoch = durable(rows.withColumn("_turn", turn.cast("int")), by="_turn"), epoch
                part = laid if self.sub_batches == 1 else laid.where(F.col("_turn") == batch)
                part = part.withColumn("_draw", dropout_draw(F.col(id), self.seed, step))
                sums = partial_sums(
                    part, state.weights, label, embedding, self.s, self.m, self.easy, self.dropout
                ).collect()
                if not sums:  # an empty sub-batch
                    state = replace(state, step=step + 1)
                    model.state = state
                    continue
                n = sums[0]["n"]
                a = np.zeros((self.n_classes, self.dim))
                for r in sums:
                    a[r["class"]] = r["sums"]
                grad = weight_slope(state.weights, a / n)
                state = adamw(state, grad, self._rate(step, total), self.weight_decay)
                model.state = state
                seen += n
                hits += sum(r["hits"] for r in sums)
                done = step + 1
                if done % self.log_every == 0 or done == total:
                    now = time.monotonic()
                    model.history.append(
                        {
                            "step": done,
                            "epoch": epoch,
                            "batch": batch + 1,
                            "loss": sum(r["loss"] for r in sums) / n,
                            "accuracy": hits / seen,
                            "steps_per_s": (done - logged) / max(now - clock, 1e-9),
                            "rate": self._rate(step, total),
                        }
                    )
                    clock, logged = now, done
                if done % self.save_every == 0:
                    if dev is not None:
                        model.history.append(self._evaluate(dev, state, id, embedding, label, done))
                        seen = hits = 0
                    if save_path is not None:
                        save_head(spark, state, save_path, vocab)
        finally:
            epoch_rows.close()
            rows.unpersist()
        return model

    def _start(self, spark: SparkSession, init: HeadState | np.ndarray | None) -> HeadState:
        if isinstance(init, HeadState):
            if init.weights.shape != (self.n_classes, self.dim):
                raise ValueError(f"saved weights {init.weights.shape}, expected {(self.n_classes, self.dim)}")
            return init
        if init is None:
            table = H.initial_weights(
                spark.range(self.n_classes).withColumnRenamed("id", "class"), self.dim, self.seed
            )
            init = H.class_matrix(table)
        matrix = np.array(init, dtype=np.float64)
        if matrix.shape != (self.n_classes, self.dim):
            raise ValueError(f"weights {matrix.shape}, expected {(self.n_classes, self.dim)}")
        return HeadState(matrix)

    def _rate(self, step: int, total: int) -> float:
        return rate_at(step, total, self.lr, self.warmup)

    def _evaluate(self, dev, state, id, embedding, label, step) -> dict:
        with owned(dev.sparkSession):
            found = H.evaluate(dev, state.weights, id, embedding, label, s=self.s).first()
        return {
            "step": step,
            "dev_loss": found["loss_batch_mean"],
            "dev_accuracy": found["accuracy"],
        }
