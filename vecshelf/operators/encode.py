"""Vocabulary and id encoding of token arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.constants import CLS_ID, MAX_LEN, SEP_ID, SPECIAL_TOKENS, UNK_ID
from vecshelf.operators.index import TokenIndex
from vecshelf.operators.lookup import lookup_join
from vecshelf.operators.ordering import with_position
from vecshelf.session import durable

BROADCAST_BYTES = 64 * 1024 * 1024


def build_vocab(df: DataFrame, tokens: str = "tokens", min_count: int = 1) -> DataFrame:
    """`(token, id, count)`: special tokens first, then by falling count and token."""
    counted = (
        df.select(F.explode(tokens).alias("token"))
        .where(~F.col("token").isin(*SPECIAL_TOKENS))
        .groupBy("token").count()
        .where(F.col("count") >= min_count)
    )
    ranked, _ = with_position(counted, F.desc("count"), F.asc("token"))
    specials = df.sparkSession.createDataFrame(
        [(t, i, 0) for i, t in enumerate(SPECIAL_TOKENS)], "token string, id bigint, count bigint"
    )
    return specials.unionByName(
        ranked.select("token", (F.col("pos") + len(SPECIAL_TOKENS)).alias("id"), "count")
    )


def encode(
    df: DataFrame,
    id: str,
    a: str,
    vocab: DataFrame,
    b: str | None = None,
    max_seq_len: int = MAX_LEN,
    keep: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`[CLS] A [SEP]` or `[CLS] A [SEP] B [SEP]` as `input_ids` and `token_type_ids`.

    Truncation counts the special tokens; of a pair the longer side is cut first. Of vocabulary rows
    with one token the smallest id counts; rows without a token do not. A vocabulary of up to
    `broadcast_bytes` (summed up first) is broadcast and looked up in Arrow batches, without a
    shuffle. A larger one is joined. Both ways give the same, whatever the rows' ids.
    """
    texts = [a] if b is None else [a, b]
    room = max_seq_len - len(texts) - 1
    if room < 0:
        raise ValueError("max_seq_len leaves no room for the special tokens")
    lengths = [F.size(F.coalesce(F.col(t), F.array().cast("array<string>"))) for t in texts]
    limits = [F.lit(room)] if b is None else _pair_limits(*lengths, room)
    cut = df.select(
        id,
        *keep,
        *[
            F.slice(F.coalesce(F.col(t), F.array().cast("array<string>")), F.lit(1), n).alias(f"_t{i}")
            for i, (t, n) in enumerate(zip(texts, limits))
        ],
    )
    names = [f"_t{i}" for i in range(len(texts))]
    words = durable(vocab.where("token is not null").groupBy("token").agg(F.min("id").alias("id")))
    size = words.agg(F.sum(F.octet_length("token") + 16).alias("bytes")).first()["bytes"] or 0
    if size <= broadcast_bytes:
        lookup = _lookup(df.sparkSession.sparkContext.broadcast(TokenIndex(words.toArrow())))
        coded = cut.select(id, *keep, *[lookup(F.col(n)).alias(n) for n in names])
    else:
        coded = _encode_by_join(cut, id, names, words, keep)
    return coded.select(id, *keep, *_assemble(names))


def _pair_limits(len_a: Column, len_b: Column, room: int) -> list[Column]:
    more, less = (room + 1) // 2, room // 2
    return [
        F.least(len_a, F.greatest(room - len_b, F.lit(more))),
        F.least(len_b, F.greatest(room - len_a, F.lit(less))),
    ]


def _assemble(names: Sequence[str]) -> list[Column]:
    one = lambda value: F.array(F.lit(value).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    ids = F.concat(one(CLS_ID), F.col(names[0]), one(SEP_ID))
    kinds = F.array_repeat(zero, F.size(names[0]) + 2)
    if len(names) == 2:
        ids = F.concat(ids, F.col(names[1]), one(SEP_ID))
        kinds = F.concat(kinds, F.array_repeat(zero + 1, F.size(names[1]) + 1))
    return [ids.alias("input_ids"), kinds.alias("token_type_ids")]


def _lookup(table):
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def ids(tokens: pa.Array) -> pa.Array:
        index = table.value
        place = index.find(tokens.flatten())
        codes = np.append(index.table.column("id").to_numpy(), UNK_ID)  # place -1 is the last one
        sizes = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes[place], pa.int64()))

    return ids


def _encode_by_join(
    cut: DataFrame, id: str, names: Sequence[str], words: DataFrame, keep: Sequence[str]
) -> DataFrame:
    def placed(side: int, name: str) -> Column:
        word = lambda t, i: F.struct(
            F.lit(side).alias("side"), i.alias("place"), t.alias("token")
        )
        return F.transform(F.col(name), word)

    sides = F.flatten(F.array(*[placed(side, n) for side, n in enumerate(names)]))
    # Rows get a key of their own, written with them: ids may repeat or be missing.
    cut = durable(cut.withColumn("_row", F.monotonically_increasing_id()))
    tokens = cut.select("_row", F.explode(sides).alias("_w")).select("_row", "_w.*")
    coded = lookup_join(
        tokens, words.withColumnRenamed("id", "_code"), "token", spread=["_row", "place"], how="left"
    ).groupBy("_row").agg(
        F.array_sort(
            F.collect_list(
                F.struct("side", "place", F.coalesce("_code", F.lit(UNK_ID)).alias("code"))
            )
        ).alias("_all")
    )

    def side_ids(side: int) -> Column:
        mine = F.filter(
            F.coalesce(F.col("_all"), F.array().cast("array<struct<side:int,place:int,code:bigint>>")),
            lambda x: x["side"] == side,
        )
        return F.transform(mine, lambda x: x["code"])

    return cut.select(id, *keep, "_row").join(coded, "_row", "left").select(
        id, *keep, *[side_ids(i).alias(n) for i, n in enumerate(names)]
    )
