"""Exact top-k search by inner product: MaxScore over sharded, dimension-wise posting lists.

Vectors become integers. A shard keeps one posting list per dimension and its extremes, which bound
what a dimension can add to a query's score. For each query, dimensions in order of their bounds are
split: the essential ones are traversed for the whole shard; of the others only candidates that
can still reach the k-th best score are probed. Lists of all shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecshelf.session import durable

SHARD_ROWS = 8_192
QUERY_ROWS = 2_048
QUERY_BLOCK = 128  # queries whose traversal is one matrix product
STEP = 16  # dimensions probed before candidates are sifted again


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null for a null vector or one with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def search_shard(
    ids: np.ndarray, lists: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (query id, ids, scores) of each query's best k in one shard, exact, ties to smaller ids.

    `lists` holds one row per dimension (its posting list), `queries` one row per query. Numbers are
    float64 of integers: sums are exact below 2**53, which `top_k` checks.
    """
    low, high = lists.min(axis=1), lists.max(axis=1)
    probe, probe_ids = lists[:, : 16 * k], ids[: 16 * k]
    for at in range(0, len(queries), QUERY_BLOCK):
        block, block_ids = queries[at : at + QUERY_BLOCK], query_ids[at : at + QUERY_BLOCK]
        bounds = np.maximum(block * low, block * high)
        orders = np.argsort(-np.abs(block) * (high - low), axis=1, kind="stable")
        ordered = np.take_along_axis(bounds, orders, axis=1)
        rest = np.zeros((len(block), block.shape[1] + 1))  # what dimensions from a place on can add
        rest[:, :-1] = np.cumsum(ordered[:, ::-1], axis=1)[:, ::-1]
        known = np.where(probe_ids == block_ids[:, None], -np.inf, block @ probe)
        worst = np.array([_kth(row, k) for row in known])
        # Essential: the fewest leading dimensions whose absence no other dimensions make good.
        hopeless = rest < worst[:, None]
        essential = np.where(hopeless.any(axis=1), hopeless.argmax(axis=1), block.shape[1])
        leading = np.zeros(block.shape, dtype=bool)
        np.put_along_axis(leading, orders, np.arange(block.shape[1]) < essential[:, None], axis=1)
        traversed = np.where(leading, block, 0) @ lists
        for i, (query_id, q, order) in enumerate(zip(block_ids, block, orders)):
            done = essential[i]
            places = np.flatnonzero(traversed[i] + rest[i, done] >= worst[i])
            places = places[ids[places] != query_id]
            scores = traversed[i, places]
            while done < len(q) and len(places):
                chosen = order[done : done + STEP]
                scores = scores + q[chosen] @ lists[np.ix_(chosen, places)]
                done += len(chosen)
                alive = scores + rest[i, done] >= worst[i]
                places, scores = places[alive], scores[alive]
            if len(places) > k:
                near = scores >= _kth(scores, k)
                places, scores = places[near], scores[near]
            best = np.lexsort((ids[places], -scores))[:k]
            yield query_id, ids[places[best]], scores[best]


def _kth(scores: np.ndarray, k: int) -> float:
    return -np.inf if len(scores) < k else np.partition(scores, len(scores) - k)[len(scores) - k]


def top_k(
    queries: DataFrame, items: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding", scale: int = 64
) -> DataFrame:
    """Each query's k best items: query_id, rank (from 1), vec_id, score; ties to the smaller id.

    An item with the query's own id is no candidate. Vectors that are null or hold null or non-finite
    components take no part, nor do rows with a null id; with fewer than k candidates all are
    returned. Items whose ids repeat are each a candidate; a repeated query id is searched once, by
    its smallest vector. Vectors must all have one length (an error says so otherwise), empty
    vectors score 0. Queries and items are
    dealt into blocks and each pair of blocks is one task's work: nothing is collected or left out.
    """
    def prepared(df):
        whole = df.select(F.col(id).cast("long").alias("id"), quantized(F.col(vector), scale).alias("v"))
        return whole.where("id is not null and v is not null")

    items = durable(prepared(items))
    # A repeated query id would be searched twice; the smallest vector stands for it.
    queries = durable(prepared(queries).groupBy("id").agg(F.min("v").alias("v")))
    n, wide, narrow, most = items.select(F.size("v").alias("w"), F.array_max(F.transform("v", F.abs)).alias("m")).agg(
        F.count(F.lit(1)), F.max("w"), F.min("w"), F.max("m")
    ).first()
    m, q_wide, q_narrow, q_most = queries.select(
        F.size("v").alias("w"), F.array_max(F.transform("v", F.abs)).alias("m")
    ).agg(F.count(F.lit(1)), F.max("w"), F.min("w"), F.max("m")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n or not m:
        return items.sparkSession.createDataFrame([], schema)
    if not wide == narrow == q_wide == q_narrow:
        raise ValueError("vectors differ in length")
    if float(most or 0) * float(q_most or 0) * wide >= 2**53:
        raise ValueError("scores would not fit exact sums; use a smaller scale")
    shards, chunks = -(-n // SHARD_ROWS), -(-m // QUERY_ROWS)

    def dealt(df, parts, others, part, other):
        place = F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")
        return df.select(place.alias(part), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), "id", "v")

    item_blocks = dealt(items, shards, chunks, "shard", "chunk")
    query_blocks = dealt(queries, chunks, shards, "chunk", "shard")

    def matrix(group: pd.DataFrame) -> np.ndarray:
        return np.array(group["v"].tolist(), dtype=np.float64).reshape(len(group), wide)

    def search(item_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(item_rows) or not len(query_rows):
            return pd.DataFrame({c: pd.Series(dtype=np.int64) for c in ("query_id", "vec_id", "score")})
        lists = np.ascontiguousarray(matrix(item_rows).T)
        ids, query_ids = item_rows["id"].to_numpy(), query_rows["id"].to_numpy()
        asked, found, scores = zip(*search_shard(ids, lists, query_ids, matrix(query_rows), k))
        return pd.DataFrame(
            {
                "query_id": np.repeat(asked, [len(x) for x in found]),
                "vec_id": np.concatenate(found),
                "score": np.concatenate(scores).astype(np.int64),
            }
        )

    found = item_blocks.groupBy("shard", "chunk").cogroup(query_blocks.groupBy("shard", "chunk")).applyInPandas(
        search, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
