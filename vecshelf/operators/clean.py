"""Cleaning profiles, tokenising and reject tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.functions import text as X
from vecshelf.operators.index import sliced
from vecshelf.operators.lookup import lookup_join
from vecshelf.session import durable

INLINE_STOPWORDS = 20_000
SLICE_BYTES = 4 * 1024 * 1024  # of texts whose tokens are Python objects at a time


def split_rejects(
    df: DataFrame, id: str, text: str, checks: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Split into good rows and rejects `(id, text, reason)`; the first failing check names it."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    marked = df.withColumn("_reason", reason)
    good = marked.where(F.col("_reason").isNull()).drop("_reason")
    rejects = marked.where(F.col("_reason").isNotNull()).select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col("_reason").alias("reason")
    )
    return good, rejects


def parse_label(
    df: DataFrame, col: str = "label", n_classes: int | None = None, out: str | None = None
) -> DataFrame:
    """Label text to BIGINT; blanks around it are allowed, junk and unknown classes become NULL."""
    stripped = X.strip_unicode(F.col(col))
    number = F.when(F.regexp_like(stripped, F.lit(r"\A[+-]?[0-9]+\z")), stripped).try_cast("bigint")
    if n_classes is not None:
        number = F.when((number >= 0) & (number < n_classes), number)
    return df.withColumn(out or col, number)


def checked_labels(
    df: DataFrame, id: str = "query", col: str = "label", n_classes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows whose label is a class number, as BIGINT, and rejects `(id, text, reason)` for the others."""
    parsed = parse_label(df, col, n_classes, out="_label")
    good, rejects = split_rejects(parsed, id, col, {"label": F.col("_label").isNull()})
    return good.withColumn(col, F.col("_label")).drop("_label"), rejects


def drop_label(df: DataFrame, col: str = "label") -> DataFrame:
    return df.drop(col)


def clean_deep(df: DataFrame, name: str, out: str = "clean") -> DataFrame:
    """Profile for the encoder: markers, then strip."""
    return df.withColumn(out, X.strip_unicode(X.remove_markers(F.col(name))))


def tokenize(
    df: DataFrame,
    col: str,
    segmenter: Callable[[str], Iterable[str]] | None = None,
    lower: bool = True,
    out: str = "tokens",
) -> DataFrame:
    """Add a token array: words, and overlapping two-character pieces of Chinese runs.

    A user segmenter runs on Arrow batches instead; a row it fails on gets NULL.
    """
    if segmenter is None:
        return df.withColumn(out, X.runs(F.col(col), lower)).withColumn(
            out, X.split_chinese(F.col(out))
        )

    def one(text: str | None) -> list[str] | None:
        try:
            return list(segmenter(text))
        except Exception:  # noqa: BLE001 - any failure of the user's segmenter rejects the row
            return None

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        cut = [pa.array([one(t) for t in part.to_pylist()], kind) for part in sliced(texts, SLICE_BYTES)]
        return pa.concat_arrays(cut) if cut else pa.array([], kind)

    return df.withColumn(out, run(F.col(col)))


def drop_stopwords(
    df: DataFrame, id: str, tokens: str, stopwords: DataFrame, inline: int | None = None
) -> DataFrame:
    """Stopword removal against a list of any size, keeping token order and repeats.

    A list of at most `inline` (`INLINE_STOPWORDS`) words (counted first) becomes a set inside the expression. A
    longer one is joined to the distinct tokens of each row, hot tokens being split by the join. NULL
    is no stopword. `id` must be unique per row.
    """
    words = durable(stopwords.select("stopword").where("stopword is not null").distinct())
    if words.count() <= (INLINE_STOPWORDS if inline is None else inline):
        kept = X.keep_tokens(F.col(tokens), 0, [r["stopword"] for r in words.collect()])
        return df.withColumn(tokens, kept)
    return _drop_by_join(df, id, tokens, words)


def _drop_by_join(df: DataFrame, id: str, tokens: str, stopwords: DataFrame) -> DataFrame:
    words = stopwords.select(F.col("stopword").alias("_token")).distinct()
    used = df.select(id, F.explode(F.array_distinct(tokens)).alias("_token"))
    hits = lookup_join(used, words, "_token", spread=[id])
    drop = hits.groupBy(id).agg(F.collect_list("_token").alias("_drop"))
    kept = F.filter(F.col(tokens), lambda t: ~F.array_contains(F.col("_drop"), t))
    return (
        df.join(drop, id, "left")
        .withColumn(tokens, F.when(F.col("_drop").isNull(), F.col(tokens)).otherwise(kept))
        .drop("_drop")
    )


def clean_baseline(
    df: DataFrame,
    name: str,
    stopwords: Iterable[str] | DataFrame = (),
    segmenter: Callable[[str], Iterable[str]] | None = None,
    lower: bool = True,
    id: str | None = None,
    out: str = "clean",
) -> DataFrame:
    """Profile for word vectors: markers, bracket spans, tokens, length, stopwords, join.

    `stopwords` is a list, or a `(stopword)` table (then `id` names the row key).
    Rows whose segmenter failed keep NULL in `tokens` and `clean`.
    """
    bare = df.withColumn(out, X.remove_markers(F.col(name)))
    bare = bare.withColumn(out, X.remove_bracket_spans(F.col(out)))
    cut = tokenize(bare, out, segmenter, lower)
    if isinstance(stopwords, DataFrame):
        kept = cut.withColumn("tokens", X.keep_tokens(F.col("tokens"), 2))
        kept = drop_stopwords(kept, id, "tokens", stopwords)
    else:
        kept = cut.withColumn("tokens", X.keep_tokens(F.col("tokens"), 2, stopwords))
    return kept.withColumn(out, X.join_tokens(F.col("tokens")))
