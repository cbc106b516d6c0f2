"""Neighbour lists kept up from run to run: each run works on what changed since the last one.

A shelf holds the catalogue's fingerprints, the vectors of texts, the vectors of ids, the lists and the published
records. A run compares fingerprints, encodes texts that were never seen, repairs the lists that the
changes touch, publishes those lists, and commits all of it as one version. A run that ends early
changes nothing but the store of encoded texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshelf.constants import DEEP_DIM, KEY_PREFIX, NEIGHBOURS, TTL_SECONDS
from vecshelf.operators.clean import clean_deep
from vecshelf.operators.difference import difference, fingerprints
from vecshelf.operators.embed import Encoder, embed_stored
from vecshelf.operators.lists import format_lists
from vecshelf.operators.neighbours import knn_lists
from vecshelf.operators.repair import repaired_lists
from vecshelf.session import durable
from vecshelf.sinks.records import records
from vecshelf.sinks.shelf import Shelf
from vecshelf.sources.catalogue import named


def run_snapshot(
    shelf: Shelf, catalogue: DataFrame, encoder_factory: Callable[[], Encoder], version: str, now: Column,
    dim: int = DEEP_DIM, k: int = NEIGHBOURS, tag: int | None = None, **options,
) -> DataFrame | None:
    """Bring the shelf to a whole catalogue `(id, name)`: ids that it lacks go. See `run_changes`."""
    if tag is not None and shelf.tag is not None and tag <= shelf.tag:
        return None
    good, _ = named(catalogue)
    good = durable(good.groupBy("id").agg(F.min("name").alias("name")))
    kept = shelf.read("catalogue")
    prints = fingerprints(good, "id", "name")
    if kept is None:
        return run_changes(shelf, good, good.select("id").limit(0), encoder_factory, version, now, dim, k, tag, **options)
    found = durable(difference(kept, prints))
    new = good.join(found.where("change != 'gone'"), "id", "left_semi")
    gone = found.where("change = 'gone'").select("id")
    return run_changes(shelf, new, gone, encoder_factory, version, now, dim, k, tag, **options)


def run_changes(
    shelf: Shelf, changed: DataFrame, gone: DataFrame, encoder_factory: Callable[[], Encoder], version: str, now: Column,
    dim: int = DEEP_DIM, k: int = NEIGHBOURS, tag: int | None = None,
    prefix: str = KEY_PREFIX, model: str | None = "deep", ttl_s: int = TTL_SECONDS, block_rows: int | None = None,
) -> DataFrame | None:
    """Bring the shelf up to new and changed rows `(id, name)` and ids that are `gone`; returns what was published.

    An id with several names counts with the smallest; rows without id or name do not count. `tag` numbers the
    batches: one that the shelf has committed is left alone (None is returned), so a batch can be replayed. Records
    are those of the lists that the batch touched; records of ids that are gone leave the table.
    """
    change = shelf.begin(tag)
    if change is None:
        return None
    good, _ = named(changed.select("id", "name"))
    good = durable(good.groupBy("id").agg(F.min("name").alias("name")))
    gone = durable(gone.select("id").where("id is not null").distinct().join(good, "id", "left_anti"))
    cleaned = clean_deep(good, "name").select("id", "clean")
    vectors = durable(embed_stored(cleaned, "id", "clean", encoder_factory, dim, shelf, version).select("id", "embedding"))
    change = shelf.begin(tag)  # beside the vectors that were just committed
    before, lists = shelf.read("embeddings"), shelf.read("lists")
    if before is None:
        touched = knn_lists(vectors, k=k, block_rows=block_rows)
    else:
        touched = repaired_lists(before, lists, vectors, gone, k, block_rows=block_rows).drop("cause")
    touched = durable(touched)
    made = durable(records(format_lists(touched), model, now, prefix, ttl_s))
    old = records(format_lists(gone.select("id", F.array().cast(touched.schema["neighbours"].dataType).alias("neighbours"))), model, now, prefix, ttl_s)
    change.upsert("catalogue", ["id"], fingerprints(good, "id", "name"), gone)
    change.upsert("embeddings", ["id"], vectors, gone)
    change.upsert("lists", ["id"], touched, gone)
    change.upsert("records", ["key"], made, old.select("key"))
    change.commit()
    return made
