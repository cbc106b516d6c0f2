"""Vectors for texts: a batch encoder, word-vector averages, dimension checks."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.functions.vectors import DOUBLES, content_key, from_matrix, to_matrix, unit_rows
from vecshelf.operators.index import TokenIndex, sliced
from vecshelf.operators.lookup import lookup_join
from vecshelf.session import durable
from vecshelf.sinks.shelf import Shelf

Encoder = Callable[..., np.ndarray]  # one list per input column, one matrix row per input row

BROADCAST_BYTES = 32 * 1024 * 1024  # of word vectors; each Python worker holds them, and an index and a matrix of that size
BLOCK_VALUES = 32 * 1024 * 1024  # numbers in the vectors of a block, if each of its tokens were another word
BLOCK_TOKENS = (100_000, 2_000_000)
GROUPS_PER_TASK = 4
SLICE_BYTES = 4 * 1024 * 1024  # of a batch that become Python objects at a time
GATHER_VALUES = 8 * 1024 * 1024  # numbers gathered at a time while averaging


class HashingEncoder:
    """A deterministic encoder: each blank-separated token adds +1 or -1 to one dimension.

    The first eight hex digits of the token's md5 choose the dimension and the sign.
    """

    def __init__(self, dim: int):
        self.dim = dim
        self._slots: dict[str, tuple[int, int]] = {}

    def _slot(self, token: str) -> tuple[int, int]:
        slot = self._slots.get(token)
        if slot is None:
            number = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
            slot = (number % self.dim, 1 - 2 * (number // self.dim % 2))
            if len(self._slots) < 100_000:
                self._slots[token] = slot
        return slot

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for row, text in zip(out, texts):
            for token in text.split(" "):
                if token:
                    place, sign = self._slot(token)
                    row[place] += sign
        return out


class HashingIdEncoder:
    """The same for token ids and their segment numbers: an id adds plus or minus (1 + segment)."""

    def __init__(self, dim: int):
        self.dim = dim

    def __call__(self, ids: Sequence[Sequence[int]], kinds: Sequence[Sequence[int]]) -> np.ndarray:
        sizes = [len(row) for row in ids]
        flat = np.array([i for row in ids for i in row], dtype=np.int64)
        kind = np.array([i for row in kinds for i in row], dtype=np.int64)
        number = flat * 2_654_435_761 % 2**32
        sign = 1 - 2 * (number // self.dim % 2)
        at = np.repeat(np.arange(len(sizes)), sizes) * self.dim + number % self.dim
        sums = np.bincount(at, sign * (1 + kind), len(sizes) * self.dim)
        return sums.reshape(len(sizes), self.dim).astype(np.float32)


def embed(
    df: DataFrame,
    id: str,
    text: str | Sequence[str],
    encoder_factory: Callable[[], Encoder],
    dim: int,
    distinct: bool = True,
    partitions: int | None = None,
    out: str = "embedding",
) -> DataFrame:
    """Add the encoder's float vector of `text`. The encoder is built once per partition.

    `text` names the input column, or several, such as token ids and segment numbers; the encoder
    gets one list per column. With `distinct`, each different input is encoded once, however often it occurs, and the vectors
    are joined back; rows without a text are left out. Encoding is spread over `partitions` tasks (default: the larger of the
    cluster's cores and the shuffle partitions), since its cost does not show in the byte sizes
    by which partitions get merged.
    """
    inputs = [text] if isinstance(text, str) else list(text)
    run = _encoding(inputs, encoder_factory, dim, out)
    if not distinct:
        schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])
        return df.mapInArrow(run, schema)
    # Inputs are told apart by two 64-bit hashes; they themselves go to the encoder only.
    keyed = _with_keys(df, inputs)
    texts = keyed.select(*inputs, "_k1", "_k2").dropDuplicates(["_k1", "_k2"])
    texts = texts.repartition(partitions or _encoding_tasks(df), "_k1", "_k2")
    schema = T.StructType([*texts.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])
    encoded = texts.mapInArrow(run, schema).select("_k1", "_k2", out)
    return lookup_join(keyed, encoded, ["_k1", "_k2"], spread=[id]).drop("_k1", "_k2")


def embed_stored(
    df: DataFrame,
    id: str,
    text: str | Sequence[str],
    encoder_factory: Callable[[], Encoder],
    dim: int,
    shelf: Shelf,
    version: str,
    partitions: int | None = None,
    out: str = "embedding",
) -> DataFrame:
    """`embed` with distinct inputs, encoding only those that no earlier run with this `version` of the encoder has.

    Vectors are kept in the shelf's table `vectors-<version>`, by two 64-bit hashes of the input. New ones are committed
    before they are joined, so a run that fails later has encoded them for good.
    """
    inputs = [text] if isinstance(text, str) else list(text)
    name, key = f"vectors-{version}", ["k1", "k2"]
    keyed = _with_keys(df, inputs)
    texts = keyed.select(*inputs, F.col("_k1").alias("k1"), F.col("_k2").alias("k2")).dropDuplicates(key)
    kept = shelf.read(name)
    unseen = durable(texts if kept is None else texts.join(kept.select(*key), key, "left_anti"))
    if kept is None or not unseen.isEmpty():
        schema = T.StructType([*unseen.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])
        spread_out = unseen.repartition(partitions or _encoding_tasks(df), *key)
        change = shelf.begin()
        change.append(name, key, spread_out.mapInArrow(_encoding(inputs, encoder_factory, dim, out), schema).select(*key, F.col(out).alias("vec")))
        change.commit()
    asked = texts.select(*key)
    vectors = shelf.read(name).join(asked, key, "left_semi").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("vec").alias(out))
    return lookup_join(keyed, vectors, ["_k1", "_k2"], spread=[id]).drop("_k1", "_k2")


def _with_keys(df: DataFrame, inputs: list[str]) -> DataFrame:
    k1, k2 = content_key(F.struct(*inputs))
    there = df.where(" and ".join(f"`{c}` is not null" for c in inputs))
    return durable(there.withColumn("_k1", k1).withColumn("_k2", k2))


def _encoding_tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _encoding(inputs: list[str], encoder_factory: Callable[[], Encoder], dim: int, out: str):
    """A task that adds vectors to Arrow batches; its encoder is built at the first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            encoder = encoder or encoder_factory()
            for part in sliced(batch, SLICE_BYTES):
                matrix = np.asarray(encoder(*[part.column(c).to_pylist() for c in inputs]), dtype=np.float32)
                if matrix.shape != (part.num_rows, dim):
                    raise ValueError(f"encoder gave {matrix.shape}, expected {(part.num_rows, dim)}")
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, from_matrix(matrix, pa.float32())],
                    names=[*part.schema.names, out],
                )

    return run


def sentence_vectors(
    df: DataFrame,
    id: str,
    tokens: str,
    vectors: DataFrame,
    dim: int,
    mode: str = "unsupervised",
    eos: Sequence[float] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    out: str = "embedding",
) -> DataFrame:
    """`(id, embedding, is_empty)` from a `(token, vec)` table.

    unsupervised: mean of the unit word vectors; words with a zero vector do not count.
    supervised: plain mean of the word vectors and the end-of-sentence vector `eos`.
    Unknown tokens do not count; a text with nothing to average gets the zero vector and
    `is_empty`. Of rows with one token the smallest vector counts; rows without token or vector do
    not. A word table of up to `broadcast_bytes` (summed up first) is broadcast and averaged in Arrow
    batches; a larger one is joined to the different words of each block of rows. Both ways give the same.
    """
    if mode not in ("unsupervised", "supervised"):
        raise ValueError(mode)
    if mode == "supervised" and (eos is None or len(eos) != dim):
        raise ValueError("supervised mode needs an end-of-sentence vector of the same dimension")
    words = vectors.where("token is not null and vec is not null").groupBy("token")
    words = durable(words.agg(F.min("vec").alias("vec")))
    size = words.agg(F.sum(F.octet_length("token") + 8 * dim).alias("bytes")).first()["bytes"] or 0
    if size > broadcast_bytes:
        return _average_by_join(df, id, tokens, words, dim, mode, eos, out)
    model = df.sparkSession.sparkContext.broadcast(WordVectors(words.toArrow(), dim, mode))
    average = _average(model, mode, eos)
    return (
        df.select(id, average(F.col(tokens)).alias("_a"))
        .select(id, F.col("_a.vec").alias(out), F.col("_a.n").alias("_n"))
        .select(id, out, (F.col("_n") == 0).alias("is_empty"))
    )


def _sum_words(row: np.ndarray, word: np.ndarray, matrix: np.ndarray, rows: int) -> np.ndarray:
    """Per row, the sum of its word vectors; each different word of a row is fetched once."""
    total = np.zeros((rows, matrix.shape[1]))
    pairs, times = np.unique(row * max(len(matrix), 1) + word, return_counts=True)
    row, word = np.divmod(pairs, max(len(matrix), 1))
    step = max(GATHER_VALUES // max(matrix.shape[1], 1), 1)
    for start in range(0, len(pairs), step):
        part = slice(start, start + step)
        owners, firsts = np.unique(row[part], return_index=True)
        values = matrix[word[part]] * times[part, None]
        total[owners] += np.add.reduceat(values, firsts, axis=0)
    return total


class WordVectors(TokenIndex):
    """Word vectors by token, as the mode wants them; derived once per worker."""

    def __init__(self, table: pa.Table, dim: int, mode: str):
        super().__init__(table)
        self.dim, self.mode = dim, mode

    def __getstate__(self):
        return {"table": self.table, "dim": self.dim, "mode": self.mode}

    @cached_property
    def matrix(self) -> np.ndarray:
        matrix = to_matrix(self.table.column("vec")) if self.table.num_rows else np.zeros((0, self.dim))
        return unit_rows(matrix) if self.mode == "unsupervised" else matrix

    @cached_property
    def counts(self) -> np.ndarray:
        """Which words count: unsupervised, zero vectors do not."""
        if self.mode == "unsupervised":
            return np.any(self.matrix != 0.0, axis=1)
        return np.ones(len(self.matrix), dtype=bool)


def _average(model, mode: str, eos: Sequence[float] | None):
    kind = T.StructType([T.StructField("vec", DOUBLES), T.StructField("n", T.LongType())])

    @F.arrow_udf(kind)
    def average(tokens: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_means(model.value, tokens, mode, eos), names=["vec", "n"])

    return average


def _means(words: WordVectors, tokens: pa.Array, mode: str, eos: Sequence[float] | None) -> list[pa.Array]:
    """The mean of each row's words, and how many count."""
    matrix, counts = words.matrix, words.counts
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(tokens)), sizes)
    word = words.find(tokens.flatten())
    use = word >= 0
    use[use] = counts[word[use]]
    total = _sum_words(row[use], word[use], matrix, len(tokens))
    n = np.bincount(row[use], minlength=len(tokens)).astype(np.int64)
    if mode == "supervised":
        total += np.asarray(eos, dtype=np.float64)
        n += 1
    return [from_matrix(total / np.maximum(n, 1)[:, None]), pa.array(n)]


def _average_by_join(
    df: DataFrame, id: str, tokens: str, words: DataFrame, dim: int, mode: str, eos, out: str
) -> DataFrame:
    """Rows in blocks that lie together, each beside the vectors of its own words: a word is sent once a block."""
    spark = df.sparkSession
    # Blocks are written with their rows: a row's number holds its partition above bit 33, and its place there.
    rows = durable(df.select(F.col(id).alias("id"), F.col(tokens).alias("tokens"), F.monotonically_increasing_id().alias("_row")))
    size = F.sum(F.greatest(F.size("tokens"), F.lit(0)).cast("long"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), size.alias("tokens")).first()
    most = min(max(BLOCK_VALUES // max(dim, 1), BLOCK_TOKENS[0]), BLOCK_TOKENS[1])
    per_block = max(1, int(most * seen["n"] // max(seen["tokens"] or 0, 1)))
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.col("_row") - F.pmod(place, F.lit(per_block))
    rows = rows.select("id", "tokens", block.alias("block"))
    used = rows.select("block", F.explode("tokens").alias("token")).where("token is not null").distinct()
    table = words.select("token", F.col("vec").cast("array<double>").alias("vec"))
    found = used.join(table, "token").select(F.col("block").alias("word_block"), "token", "vec")
    kind = T.StructType([rows.schema["id"], T.StructField("vec", DOUBLES), T.StructField("n", T.LongType())])

    def run(left, right):
        if not left.num_rows:
            return pa.table({"id": left.column("id"), "vec": pa.array([], pa.list_(pa.float64())), "n": pa.array([], pa.int64())})
        own = WordVectors(right.select(["token", "vec"]), dim, mode)
        vec, n = _means(own, left.column("tokens").combine_chunks(), mode, eos)
        return pa.table({"id": left.column("id"), "vec": vec, "n": n})

    blocks = math.ceil(seen["n"] / per_block)
    least = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(1, min(blocks, max(least, blocks // GROUPS_PER_TASK)))
    means = (
        rows.repartition(tasks, "block").groupBy("block")
        .cogroup(found.repartition(tasks, "word_block").groupBy("word_block"))
        .applyInArrow(run, kind)
    )
    return means.select(F.col("id").alias(id), F.col("vec").alias(out), (F.col("n") == 0).alias("is_empty"))


def dimension_range(df: DataFrame, col: str = "embedding") -> DataFrame:
    """One row: shortest and longest vector, number of rows, rows without a vector."""
    size = F.size(col)
    return df.agg(
        F.min(F.when(F.col(col).isNotNull(), size)).cast("bigint").alias("min_dim"),
        F.max(F.when(F.col(col).isNotNull(), size)).cast("bigint").alias("max_dim"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(col).isNull()).alias("n_null"),
    )


def check_dim(df: DataFrame, dim: int, col: str = "embedding") -> DataFrame:
    """Raise unless every row has a vector of `dim` values; else give `df` back."""
    seen = dimension_range(df, col).first()
    if seen["n"] and (seen["n_null"] or seen["min_dim"] != dim or seen["max_dim"] != dim):
        raise ValueError(f"expected {dim} dimensions, found {seen.asDict()}")
    return df
