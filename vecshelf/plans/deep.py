"""Catalogue to neighbour lists with a text encoder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from vecshelf.constants import DEEP_DIM, NEIGHBOURS
from vecshelf.operators.clean import clean_deep
from vecshelf.operators.counts import RunCounts
from vecshelf.operators.embed import Encoder, embed
from vecshelf.operators.lists import format_lists
from vecshelf.operators.neighbours import knn_lists
from vecshelf.session import durable
from vecshelf.sources.catalogue import named


def deep_vectors(
    catalogue: DataFrame,
    encoder_factory: Callable[[], Encoder],
    dim: int = DEEP_DIM,
    counts: RunCounts | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`(id, embedding)` and the rejects `(id, text, reason)` of a `(id, name)` catalogue.

    Each stage is written once: later jobs read it several times, encoding is costly, and the
    counts are those of the very rows that were written.
    """
    watch = counts.watch if counts else (lambda _, df: df)
    loaded = durable(watch("loaded", catalogue))
    good, rejects = named(loaded)
    cleaned = durable(watch("cleaned", clean_deep(good, "name").select("id", "clean")))
    vectors = embed(cleaned, "id", "clean", encoder_factory, dim).select("id", "embedding")
    return durable(watch("embedded", vectors)), watch("rejected", rejects)


def deep_lists(
    catalogue: DataFrame,
    encoder_factory: Callable[[], Encoder],
    dim: int = DEEP_DIM,
    k: int = NEIGHBOURS,
    drop: str | None = "self",
    counts: RunCounts | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`(id, value)`, each product's nearest products as text, and the rejects."""
    vectors, rejects = deep_vectors(catalogue, encoder_factory, dim, counts)
    lists = format_lists(knn_lists(vectors, k=k, drop=drop))
    return (counts.watch("searched", lists) if counts else lists), rejects
