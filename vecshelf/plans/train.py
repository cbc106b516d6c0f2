"""Labelled files to a fitted, evaluated and saved margin head."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.constants import DEEP_DIM, MAX_LEN_TRAIN, N_CLASSES
from vecshelf.operators.clean import checked_labels, tokenize
from vecshelf.operators.counts import RunCounts
from vecshelf.operators.embed import Encoder, embed
from vecshelf.operators.encode import build_vocab, encode
from vecshelf.operators.fit import ArcHead, ArcHeadModel
from vecshelf.session import durable
from vecshelf.sinks.heads import load_head
from vecshelf.sources.labelled import parse_labelled, read_lines


@dataclass
class TrainRun:
    model: ArcHeadModel
    vocab: DataFrame
    rejects: DataFrame  # (text, reason) of the training files
    counts: DataFrame  # one row: loaded, rejected, embedded, balanced


def train_head(
    spark: SparkSession,
    train_path: str,
    encoder_factory: Callable[[], Encoder],
    dim: int = DEEP_DIM,
    n_classes: int = N_CLASSES,
    dev_path: str | None = None,
    save_path: str | None = None,
    resume: bool = False,
    segmenter: Callable[[str], Iterable[str]] | None = None,
    min_count: int = 1,
    max_seq_len: int = MAX_LEN_TRAIN,
    **options,
) -> TrainRun:
    """Read, encode, embed and fit; evaluate on `dev_path` and save with the vocabulary on the way.

    Lines with a wrong number of fields, labels that are no class and texts on which the segmenter fails go to the
    rejects. The encoder takes token ids and segment numbers, cut to `max_seq_len`. `resume` goes on
    from the last saved step, if there is one. `options` are those of `ArcHead`.
    """
    counts = RunCounts()
    rows, rejects, loaded = _labelled(spark, train_path, n_classes, segmenter)
    vocab = durable(build_vocab(rows, min_count=min_count))

    def vectors(tokens: DataFrame) -> DataFrame:
        coded = encode(tokens, "id", "tokens", vocab, max_seq_len=max_seq_len, keep=["label"])
        return embed(coded, "id", ["input_ids", "token_type_ids"], encoder_factory, dim).select("id", "embedding", "label")

    embedded = durable(counts.watch("embedded", vectors(rows)))
    dev = None
    if dev_path is not None:
        dev = durable(vectors(_labelled(spark, dev_path, n_classes, segmenter)[0]))
    init = load_head(spark, save_path) if resume and save_path else None
    head = ArcHead(n_classes=n_classes, dim=dim, **options)
    model = head.fit(embedded, init=init, dev=dev, save_path=save_path, vocab=vocab)
    n_rejected, n_embedded = rejects.count(), counts.counts()["embedded"]
    summary = spark.createDataFrame(
        [(loaded, n_rejected, n_embedded, loaded == n_rejected + n_embedded)],
        "loaded bigint, rejected bigint, embedded bigint, balanced boolean",
    )
    return TrainRun(model, vocab, rejects, summary)


def _labelled(spark, path, n_classes, segmenter) -> tuple[DataFrame, DataFrame, int]:
    """Written rows `(id, tokens, label)`, written rejects, and the number of lines."""
    lines = durable(read_lines(spark, path))
    parsed, wrong = parse_labelled(lines, mode="reject")
    good, unknown = checked_labels(parsed, "query", "label", n_classes)
    cut = durable(tokenize(good, "query", segmenter))
    failed = cut.where("tokens is null").select(F.col("query").alias("text"), F.lit("segmenter_failed").alias("reason"))
    rejects = durable(wrong.unionByName(unknown.select("text", "reason")).unionByName(failed))
    rows = durable(
        cut.where("tokens is not null").select(F.monotonically_increasing_id().alias("id"), "tokens", "label")
    )
    return rows, rejects, lines.count()
