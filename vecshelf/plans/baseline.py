"""Catalogue to neighbour lists with word vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.constants import BASELINE_DIM, NEIGHBOURS
from vecshelf.operators.clean import clean_baseline, split_rejects
from vecshelf.operators.counts import RunCounts
from vecshelf.operators.embed import sentence_vectors
from vecshelf.operators.lists import format_lists
from vecshelf.operators.neighbours import knn_lists
from vecshelf.session import durable
from vecshelf.sources.catalogue import named


def baseline_tokens(
    catalogue: DataFrame,
    stopwords: Iterable[str] | DataFrame = (),
    segmenter: Callable[[str], Iterable[str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`(id, tokens, clean)` and the rejects (no id or name, or the segmenter failed)."""
    good, unnamed = named(catalogue)
    cut = durable(clean_baseline(good, "name", stopwords, segmenter, id="id"))
    kept, failed = split_rejects(
        cut, "id", "name", {"segmenter_failed": F.col("tokens").isNull()}
    )
    return kept.select("id", "tokens", "clean"), unnamed.unionByName(failed)


def baseline_lists(
    catalogue: DataFrame,
    word_vectors: DataFrame,
    stopwords: Iterable[str] | DataFrame = (),
    segmenter: Callable[[str], Iterable[str]] | None = None,
    dim: int = BASELINE_DIM,
    k: int = NEIGHBOURS,
    mode: str = "unsupervised",
    eos=None,
    drop: str | None = "self",
    skip_empty: bool = False,
    counts: RunCounts | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`(id, value)`, each product's nearest products as text, and the rejects.

    Names without any known word have the zero vector and tie with each other; `skip_empty` sends
    them to the rejects instead.
    """
    watch = counts.watch if counts else (lambda _, df: df)
    loaded = durable(watch("loaded", catalogue))
    tokens, rejects = baseline_tokens(loaded, stopwords, segmenter)
    cleaned = durable(watch("cleaned", tokens))
    vectors = sentence_vectors(cleaned, "id", "tokens", word_vectors, dim, mode, eos)
    if skip_empty:
        vectors = durable(vectors)
        empty = vectors.where("is_empty").select("id", F.lit("").alias("text"), F.lit("no_known_word").alias("reason"))
        rejects = rejects.unionByName(empty)
        vectors = vectors.where("not is_empty")
    vectors = durable(watch("embedded", vectors.select("id", "embedding")))
    lists = watch("searched", format_lists(knn_lists(vectors, k=k, drop=drop)))
    return lists, watch("rejected", rejects)
