"""Neighbour lists after a batch of new, changed and gone vectors, without searching all of them again.

A list is touched in two ways. It loses a neighbour that is gone or has moved: it is searched anew. Or
a new vector comes closer than its last neighbour: the vector is put in. The latter lists are found by a reverse
bound: vectors that stay lie in a tree whose balls are widened by the distance of each list's last
neighbour, and a new vector goes down only to balls that it lies in.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.constants import NEIGHBOURS
from vecshelf.operators import neighbours as N
from vecshelf.operators import tree
from vecshelf.operators.sweep import sweep, unit_rows
from vecshelf.session import durable


def repaired_lists(
    vectors: DataFrame,
    lists: DataFrame,
    changed: DataFrame,
    gone: DataFrame,
    k: int = NEIGHBOURS,
    id: str = "id",
    vector: str = "embedding",
    block_rows: int | None = None,
) -> DataFrame:
    """`(id, neighbours, cause)`: the lists that the batch touches, as `knn_lists(drop="self")` would have them after it.

    `vectors` (id, embedding) and `lists` (id, neighbours) are those before the batch, one row per id. `changed` has the
    vectors of new and changed ids, `gone` the ids that leave; an id in both is changed. `cause` is new (also for
    changed ids), left (a neighbour is gone or has moved) or entered. Lists not in the result stay as they are.
    """
    changed = durable(changed.select(F.col(id).alias("id"), F.col(vector).alias("vec")))
    moved = durable(changed.select("id").unionByName(gone.select(F.col(id).alias("id"))).distinct())
    stay = vectors.select(F.col(id).alias("id"), F.col(vector).alias("vec")).join(moved, "id", "left_anti")
    held = lists.select(F.col(id).alias("id"), "neighbours").join(moved, "id", "left_anti")
    broken = durable(
        held.select("id", F.explode("neighbours.neighbour_id").alias("n"))
        .join(moved.select(F.col("id").alias("n")), "n", "left_semi").select("id").distinct()
    )
    after = durable(stay.unionByName(changed))
    again = durable(
        changed.select("id", F.lit("new").alias("cause")).unionByName(broken.select("id", F.lit("left").alias("cause")))
    )
    asked = durable(after.join(again, "id", "left_semi"))
    searched = N.knn_lists(asked, after, k, "id", "vec", "self", block_rows).join(again, "id")
    if changed.isEmpty():
        return searched
    whole = stay.join(broken, "id", "left_anti").join(held, "id", "left").select(
        "id", "vec", F.coalesce("neighbours", F.array().cast(lists.schema["neighbours"].dataType)).alias("neighbours")
    )
    return searched.unionByName(_entered(durable(whole), changed, k, block_rows).withColumn("cause", F.lit("entered")))


def _entered(whole: DataFrame, changed: DataFrame, k: int, block_rows: int | None) -> DataFrame:
    """Lists of `whole` (id, vec, neighbours) that some vector of `changed` enters, with it put in."""
    seen = changed.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    cores = whole.sparkSession.sparkContext.defaultParallelism
    n = whole.count()
    rows = block_rows or min(N._block_rows(seen["dim"]), max(N.SPLIT_ROWS, math.ceil(max(n, 1) / cores)))
    if n == 0:
        return whole.select("id", "neighbours")
    last = F.when(F.size("neighbours") >= k, F.element_at("neighbours.d2", -1))
    # Rows are told apart by their ids, as each has a bound of its own.
    k1, k2 = F.xxhash64(F.lit(1), "id"), F.xxhash64(F.lit(2), "id")
    room = F.sqrt(F.coalesce(last, F.lit(math.inf)) * (1 + tree.TIE_ROOM))
    reps = durable(
        whole.select("id", k1.alias("k1"), k2.alias("k2"), "vec", F.lit(1).alias("copy"), room.alias("room"), last.alias("bound"))
    )
    built = tree.build(reps, seen["dim"], rows, room="room")
    coming = changed.select(
        F.col("id").alias("item"), F.xxhash64(F.lit(1), "id").alias("k1"), F.xxhash64(F.lit(2), "id").alias("k2"), "vec",
        F.lit(0.0).alias("bound"),
    )
    size = unit_rows(seen["dim"])
    levels = tree.bundles(built, size)
    bundled = durable(tree.bundle_of(built, levels).withColumnRenamed("bundle", "node"))
    called = durable(
        tree.calls(levels, coming, size).withColumn("node", F.element_at("calls", 1))
        .select(F.col("item").alias("id"), "k1", "vec", "node", "calls")
    )
    held = durable(tree._numbered(built.items, bundled, "leaf").select("k1", "k2", "vec", "bound", "node"))
    found = sweep(held, called, k, seen["dim"], False)
    found = found.where(F.size("list") > 0).select("k1", "k2", F.col("list").alias("found"))
    better = found.groupBy("k1", "k2").agg(F.flatten(F.collect_list("found")).alias("found"))  # one list a task
    old = whole.select("id", "neighbours", k1.alias("k1"), k2.alias("k2"))
    kind = whole.schema["neighbours"].dataType

    def merge(batches):
        for batch in batches:
            out, ids = [], []
            for row, held_list, more in zip(*(c.to_pylist() for c in batch.columns)):
                entries = [(e["d2"], e["neighbour_id"]) for e in held_list] + [(e["d2"], e["neighbour_id"]) for e in more]
                ties = N.tie_key(np.array([d for d, _ in entries]))
                order = sorted(range(len(entries)), key=lambda i: (ties[i], entries[i][1]))[:k]
                if any(i >= len(held_list) for i in order):
                    ids.append(row)
                    out.append([{"d2": entries[i][0], "neighbour_id": entries[i][1]} for i in order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(out, batch.schema.field(1).type)], names=["id", "neighbours"]
            )

    schema = T.StructType([whole.schema["id"], T.StructField("neighbours", kind)])
    return old.join(better, ["k1", "k2"]).select("id", "neighbours", "found").mapInArrow(merge, schema)
