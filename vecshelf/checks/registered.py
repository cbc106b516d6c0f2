"""The registered queries: each runs one operator, or a whole plan, over whole tables.

Vectors come out in long form `(id, place, value)` rounded to six digits, token ids as text, so
that results compare by value. Text inputs get markers, bracket spans and wide blanks added around
the whole text, as the tables hold none.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.constants import MAX_LEN_INFER
from vecshelf.functions import text as X
from vecshelf.functions import vectors as V
from vecshelf.operators import batching, clean, compare, encode, fit, head, neighbours, sharded
from vecshelf.operators.counts import RunCounts
from vecshelf.operators.difference import difference, fingerprints
from vecshelf.operators.embed import (
    HashingEncoder,
    HashingIdEncoder,
    dimension_range,
    embed,
    embed_stored,
    sentence_vectors,
)
from vecshelf.operators.lists import neighbour_lists
from vecshelf.operators.repair import repaired_lists
from vecshelf.plans.baseline import baseline_lists, baseline_tokens
from vecshelf.plans.daily import run_snapshot
from vecshelf.plans.deep import deep_lists
from vecshelf.plans.train import train_head
from vecshelf.session import durable, shared_folder, spread
from vecshelf.sinks import records as R
from vecshelf.sinks.heads import load_head, save_head
from vecshelf.sinks.shelf import Shelf
from vecshelf.sources.catalogue import named, read_catalogue
from vecshelf.sources.labelled import FIELDS_TSV, parse_labelled, read_labelled
from vecshelf.sources.lists import read_stopwords, read_word_vectors
from vecshelf.streaming.publish import publish_stream

STOPWORDS = ["the", "and", "des", "les", "und", "die", "der", "que", "los", "est", "那些"]
COMMON_SHARE = 0.1  # a token in more of the documents than this is a stopword of the derived table
WORD_DIM = 16
WORD_DIM_NAMES = 8
ENCODER_DIM = 32
NOW = "2024-01-08 00:00:00"
SEED = 7

_registry: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_registry)


def query(fn):
    _registry[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/check-{uuid.uuid4().hex}"


def r6(value: Column | str) -> Column:
    """Six digits, and no negative zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), 6) + F.lit(0.0)


def long_form(df: DataFrame, id: str, vector: str) -> DataFrame:
    return df.select(id, F.posexplode(vector).alias("place", "value")).select(
        F.col(id).alias("id"), F.col("place").cast("bigint").alias("place"), r6("value").alias("value")
    )


def id_text(col: str) -> Column:
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


def dressed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as catalogue names, with markers, spans and Chinese text around the whole text."""
    name = F.concat(
        F.lit("　【福利秒杀】【"), F.col("source"), F.lit("】["), F.col("lang"),
        F.lit("](新品)[x["), F.col("lang"), F.lit("]] 苹果手机那些 "), F.col("text"), F.lit(" 源本\t "),
    )
    docs = spread(table(spark, sf, "documents"))
    return docs.select(F.col("doc_id").alias("id"), name.alias("name"))


def document_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The documents' tokens, written once: the queries below read them several times."""
    docs = spread(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"))
    return durable(clean.tokenize(docs, "text").select("id", "tokens"))


def word_vectors(tokens: DataFrame, dim: int, column: str = "tokens") -> DataFrame:
    """Made-up word vectors for the table's own words that occur twice or more; rarer words have none."""
    words = tokens.select(F.explode(column).alias("token")).groupBy("token").count().where("count > 1")
    places = F.sequence(F.lit(0), F.lit(dim - 1))
    values = F.transform(places, lambda j: X.hash_number(F.col("token"), j) / F.lit(2.0**32) - 0.5)
    return words.select("token", values.alias("vec"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", F.col("label").cast("bigint").alias("label")
    )


def labelled_lines(spark: SparkSession, sf: str, sep: str, middle: bool) -> DataFrame:
    """The lines of all labelled documents as text lines of a labelled file; blank lines stay."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    line = docs.select(
        "doc_id", "lang", F.col("quality").cast("string").alias("label"),
        F.explode(F.split("text", "\n")).alias("line"),
    )
    parts = [F.col("line"), *([F.col("lang")] if middle else []), F.concat(F.lit(" "), "label")]
    return line.select(F.concat_ws(sep, *parts).alias("value"))


# Sources, filters, rejects


@query
def catalogue_up(spark, sf):
    return read_catalogue(table(spark, sf, "part"), "p_brand", "p_name", "p_type", "ECONOMY")


@query
def catalogue_one_row(spark, sf):
    return read_catalogue(
        table(spark, sf, "part"), "p_brand", "p_name", "p_type", "ECONOMY", one_row_per_id=True
    )


@query
def catalogue_rejects(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.expr("nullif(lang, 'fr')").alias("name")
    )
    good, rejects = named(docs)
    return good.groupBy(F.lit("good").alias("reason")).agg(F.count("name").alias("n")).unionByName(
        rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    )


@query
def labelled_read(spark, sf):
    good, _ = parse_labelled(labelled_lines(spark, sf, ",", False), mode="reject")
    return clean.parse_label(good, n_classes=2)


@query
def labelled_read_tabs(spark, sf):
    good, _ = parse_labelled(
        labelled_lines(spark, sf, "\t", True), "\t", FIELDS_TSV, mode="reject"
    )
    return clean.parse_label(good, n_classes=2)


@query
def labelled_unlabelled(spark, sf):
    good, _ = parse_labelled(labelled_lines(spark, sf, ",", False), mode="reject")
    return clean.drop_label(good)


@query
def labelled_rejects(spark, sf):
    _, rejects = parse_labelled(labelled_lines(spark, sf, ",", False), mode="reject")
    return rejects


@query
def labelled_files(spark, sf):
    """Lines written to several files, each with a header line, and read back."""
    path = scratch(spark)
    lines = labelled_lines(spark, sf, ",", False).repartition(5)
    lines.write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    good, rejects = read_labelled(spark, path, mode="reject")
    return good.select(F.concat_ws(",", "query", "label").alias("line")).unionByName(
        rejects.select(F.col("text").alias("line"))
    )


@query
def stopword_file(spark, sf):
    path = scratch(spark)
    _common(document_tokens(spark, sf)).coalesce(1).write.text(path)
    return read_stopwords(spark, path)


@query
def word_vector_file(spark, sf):
    path = scratch(spark)
    words = word_vectors(document_tokens(spark, sf), WORD_DIM_NAMES)
    values = F.array_join(F.transform("vec", lambda v: F.round(v, 4).cast("string")), " ")
    words.select(F.concat_ws(" ", "token", values)).write.text(path)
    return long_form(read_word_vectors(spark, path), "token", "vec")


# Text


@query
def clean_deep(spark, sf):
    return clean.clean_deep(dressed(spark, sf), "name").select("id", "clean")


@query
def clean_baseline(spark, sf):
    return clean.clean_baseline(dressed(spark, sf), "name", STOPWORDS).select("id", "clean")


@query
def bracket_spans(spark, sf):
    spans = X.remove_bracket_spans(F.col("name"))
    return dressed(spark, sf).select("id", spans.alias("clean"))


@query
def stopword_tokens(spark, sf):
    """Stopwords from a table: the tokens found in many documents."""
    tokens = document_tokens(spark, sf)
    kept = clean.drop_stopwords(tokens, "id", "tokens", _common(tokens))
    return kept.select("id", X.join_tokens(F.col("tokens")).alias("clean"))


@query
def stopword_join(spark, sf):
    """The same by a join, with stopwords that repeat or are missing."""
    tokens = document_tokens(spark, sf)
    words = durable(_common(tokens))
    words = words.union(words).union(words.limit(1).select(F.lit(None).cast("string")))
    kept = clean.drop_stopwords(tokens, "id", "tokens", words, inline=0)
    return kept.select("id", X.join_tokens(F.col("tokens")).alias("clean"))


def _common(tokens: DataFrame) -> DataFrame:
    return (
        tokens.select("id", F.explode(F.array_distinct("tokens")).alias("stopword"))
        .groupBy("stopword").count()
        .where(F.col("count") > COMMON_SHARE * tokens.count())
        .select("stopword")
    )


def _cut_at_blanks(text: str) -> list[str]:
    """A user segmenter that fails on texts without a comma."""
    if "," not in text:
        raise ValueError("no comma")
    return text.split(" ")


@query
def segmenter_tokens(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("name"))
    kept, _ = baseline_tokens(docs, STOPWORDS, _cut_at_blanks)
    return kept.select("id", "clean")


@query
def segmenter_rejects(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("name"))
    _, rejects = baseline_tokens(docs, STOPWORDS, _cut_at_blanks)
    return rejects


# Encoding and batches


@query
def vocab(spark, sf):
    return encode.build_vocab(document_tokens(spark, sf))


@query
def encode_single(spark, sf):
    tokens = document_tokens(spark, sf)
    words = encode.build_vocab(tokens, min_count=2)
    coded = encode.encode(tokens, "id", "tokens", words, max_seq_len=128)
    return coded.select("id", id_text("input_ids").alias("input_ids"), id_text("token_type_ids").alias("token_type_ids"))


def _worse(words: DataFrame) -> DataFrame:
    """A vocabulary with each word a second time under a larger id, and rows without a word."""
    again = words.select("token", (F.col("id") + 1_000_000).alias("id"), "count")
    return words.union(again).union(again.select(F.lit(None).cast("string"), "id", "count"))


@query
def encode_single_join(spark, sf):
    """The same by a join, for rows without ids, from a vocabulary with repeats and gaps."""
    tokens = document_tokens(spark, sf)
    words = _worse(encode.build_vocab(tokens, min_count=2))
    rows = tokens.select(F.lit(None).cast("int").alias("none"), F.col("id").alias("doc"), "tokens")
    coded = encode.encode(rows, "none", "tokens", words, max_seq_len=128, keep=["doc"], broadcast_bytes=0)
    return coded.select(
        F.col("doc").alias("id"), id_text("input_ids").alias("input_ids"), id_text("token_type_ids").alias("token_type_ids")
    )


@query
def encode_pair(spark, sf):
    return _encoded_pairs(spark, sf)


@query
def encode_pair_join(spark, sf):
    return _encoded_pairs(spark, sf, broadcast_bytes=0)


def _encoded_pairs(spark, sf, **options):
    turns = clean.tokenize(table(spark, sf, "conversations"), "text")
    words = encode.build_vocab(turns)
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("tokens").alias("a"))
    given = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("tokens").alias("b")
    )
    pairs = asked.join(given, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "a", "b"
    )
    coded = encode.encode(pairs, "id", "a", words, b="b", max_seq_len=50, **options)
    return coded.select("id", id_text("input_ids").alias("input_ids"), id_text("token_type_ids").alias("token_type_ids"))


@query
def batches_seq(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return batching.batches(docs, "id", 128).select("id", "pos", "batch_id")


@query
def batches_shuffled(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    placed = batching.batches(docs, "id", 32, shuffle=True, seed=SEED, epoch=1, world=3)
    return placed.select("id", "pos", "batch_id", F.col("rank").cast("bigint").alias("rank"))


@query
def batches_permuted(spark, sf):
    """Two epochs over rows that are laid out once."""
    placed, n = batching.laid_out(table(spark, sf, "documents").select(F.col("doc_id").alias("id")), "id")
    epochs = [
        batching.epoch_batches(placed, n, 32, SEED, epoch, world=3).withColumn("epoch", F.lit(epoch).cast("bigint"))
        for epoch in (0, 1)
    ]
    return epochs[0].unionByName(epochs[1]).select("epoch", "id", "pos", "batch_id", F.col("rank").cast("bigint").alias("rank"))


def _padded(spark, sf):
    tokens = document_tokens(spark, sf)
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.array(F.col("quality").cast("bigint")).alias("label")
    )
    words = encode.build_vocab(tokens)
    coded = encode.encode(
        tokens.join(labels, "id"), "id", "tokens", words, max_seq_len=50, keep=["label"]
    )
    return batching.pad(batching.batches(coded, "id", 32), {"input_ids": 0, "token_type_ids": 0})


@query
def pad_batch(spark, sf):
    return _padded(spark, sf).select(
        "batch_id", "id", id_text("input_ids").alias("input_ids"), id_text("token_type_ids").alias("token_type_ids")
    )


@query
def collate(spark, sf):
    whole = batching.collate(_padded(spark, sf), ["input_ids", "token_type_ids", "label"])
    return whole.select(
        "batch_id",
        F.size("input_ids").cast("bigint").alias("n_rows"),
        F.size(F.element_at("input_ids", 1)).cast("bigint").alias("width"),
        _rows_text("input_ids").alias("input_ids"),
        _rows_text("label").alias("labels"),
    )


def _rows_text(col: str) -> Column:
    row = lambda r: F.array_join(F.transform(r, lambda x: x.cast("string")), ",")
    return F.array_join(F.transform(col, row), ";")


@query
def mapped_batches(spark, sf):
    """A user function over batches of whole texts."""

    def lengths(frames):
        for frame in frames:
            yield frame.assign(n=frame["text"].str.len())[["id", "n"]]

    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return batching.map_batches(docs, lengths, "id bigint, n bigint")


# Vectors


@query
def embed_names(spark, sf):
    names = read_catalogue(table(spark, sf, "part"), "p_partkey", "p_name", None)
    cleaned = clean.clean_deep(names, "name")
    return long_form(
        embed(cleaned, "id", "clean", lambda: HashingEncoder(ENCODER_DIM), ENCODER_DIM), "id", "embedding"
    )


@query
def embed_documents(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return long_form(
        embed(docs, "id", "text", lambda: HashingEncoder(ENCODER_DIM), ENCODER_DIM), "id", "embedding"
    )


@query
def embed_ids(spark, sf):
    """An encoder over token ids, cut to the length that lists are made with."""
    tokens = document_tokens(spark, sf)
    coded = encode.encode(tokens, "id", "tokens", encode.build_vocab(tokens), max_seq_len=MAX_LEN_INFER)
    columns = ["input_ids", "token_type_ids"]
    return long_form(
        embed(coded, "id", columns, lambda: HashingIdEncoder(ENCODER_DIM), ENCODER_DIM), "id", "embedding"
    )


@query
def sentence_vector(spark, sf):
    tokens = document_tokens(spark, sf)
    found = sentence_vectors(tokens, "id", "tokens", word_vectors(tokens, WORD_DIM), WORD_DIM)
    return long_form(found, "id", "embedding")


@query
def sentence_vector_sup(spark, sf):
    tokens = document_tokens(spark, sf)
    eos = [j / WORD_DIM for j in range(WORD_DIM)]
    found = sentence_vectors(
        tokens, "id", "tokens", word_vectors(tokens, WORD_DIM), WORD_DIM, "supervised", eos
    )
    return long_form(found, "id", "embedding")


@query
def sentence_vector_join(spark, sf):
    """The same by a join, from a word table with repeats and gaps."""
    tokens = document_tokens(spark, sf)
    words = durable(word_vectors(tokens, WORD_DIM))
    larger = words.select("token", F.transform("vec", lambda v: v + 1).alias("vec"))
    words = words.union(larger).union(words.select(F.lit(None).cast("string"), "vec"))
    found = sentence_vectors(tokens, "id", "tokens", words, WORD_DIM, broadcast_bytes=0)
    return long_form(found, "id", "embedding")


@query
def l2_normalise(spark, sf):
    """Over vectors shifted and stretched, as the table's own have unit length."""
    moved = F.transform("embedding", lambda v: (v + 0.25) * (F.col("label") + 1))
    rows = vectors(spark, sf).withColumn("embedding", moved)
    return long_form(rows.withColumn("unit", V.l2_normalise(F.col("embedding"))), "id", "unit")


@query
def dim_check(spark, sf):
    return dimension_range(vectors(spark, sf))


def _projection(dim: int) -> np.ndarray:
    grid = np.arange(dim)[:, None] * 7 + np.arange(8)[None, :] * 3
    return (grid % 11 - 5) / 10.0


@query
def project_linear(spark, sf):
    rows = vectors(spark, sf)
    dim = dimension_range(rows).first()["max_dim"]
    out = V.project(F.col("embedding"), _projection(dim), np.arange(8) / 8.0)
    return long_form(rows.withColumn("out", out), "id", "out")


@query
def dropout(spark, sf):
    dropped = V.dropout(F.col("embedding"), F.col("id"), 0.1, SEED, 1)
    return long_form(vectors(spark, sf).withColumn("out", dropped), "id", "out")


# Margin head


def _centroids(spark, sf):
    return head.class_centroids(vectors(spark, sf))


@query
def class_centroids(spark, sf):
    return long_form(_centroids(spark, sf).withColumnRenamed("class", "id"), "id", "w")


@query
def initial_weights(spark, sf):
    classes = vectors(spark, sf).select(F.col("label").alias("class")).distinct()
    weights = head.initial_weights(classes, 64, SEED)
    return long_form(weights.withColumnRenamed("class", "id"), "id", "w")


@query
def cosine_logits(spark, sf):
    scored = head.cosine_logits(vectors(spark, sf), _centroids(spark, sf))
    return long_form(scored, "id", "logits")


@query
def cosine_logits_feature_axis(spark, sf):
    scored = head.cosine_logits(
        vectors(spark, sf), _centroids(spark, sf), norm_axis="feature"
    )
    return long_form(scored, "id", "logits")


@query
def arc_logits(spark, sf):
    return long_form(head.arc_logits(vectors(spark, sf), _centroids(spark, sf)), "id", "logits")


@query
def arc_logits_easy(spark, sf):
    scored = head.arc_logits(vectors(spark, sf), _centroids(spark, sf), easy=True)
    return long_form(scored, "id", "logits")


@query
def arc_logits_feature_axis(spark, sf):
    scored = head.arc_logits(vectors(spark, sf), _centroids(spark, sf), norm_axis="feature")
    return long_form(scored, "id", "logits")


@query
def cross_entropy(spark, sf):
    scored = head.arc_logits(vectors(spark, sf), _centroids(spark, sf))
    return head.cross_entropy(scored).select("id", r6("loss").alias("loss"))


@query
def train_accuracy(spark, sf):
    scored = head.arc_logits(vectors(spark, sf), _centroids(spark, sf), m=0.05)
    return head.accuracy(scored).select("n", r6("accuracy").alias("accuracy"))


@query
def eval_head(spark, sf):
    found = head.evaluate(vectors(spark, sf), _centroids(spark, sf), "id", batch_size=128)
    return found.select("n", *[r6(c).alias(c) for c in found.columns if c != "n"])


@query
def predict(spark, sf):
    return head.predict(vectors(spark, sf), _centroids(spark, sf)).select("id", "predicted")


@query
def grad_step(spark, sf):
    found = fit.grad_step(vectors(spark, sf), _centroids(spark, sf))
    return found.select("class", "dim", r6("g").alias("g"))


@query
def fit_head(spark, sf):
    rows = vectors(spark, sf)
    size = rows.agg(F.max("label").alias("top"), F.max(F.size("embedding")).alias("dim")).first()
    model = fit.ArcHead(
        n_classes=size["top"] + 1, dim=size["dim"], epochs=6, lr=0.05, log_every=1
    ).fit(rows)
    return model.history_table(spark)


@query
def fit_step(spark, sf):
    """One whole step of fitting, from the class centroids: gradient, AdamW, decay."""
    rows, start = vectors(spark, sf), head.class_matrix(_centroids(spark, sf))
    model = fit.ArcHead(
        n_classes=start.shape[0], dim=start.shape[1], epochs=1, lr=0.05, warmup=0.0, dropout=0.0
    ).fit(rows, init=start)
    return long_form(model.weight_table(spark).withColumnRenamed("class", "id"), "id", "w")


@query
def fit_run(spark, sf):
    """The log of a whole fit, from the class centroids: losses depend on all steps before."""
    rows, start = vectors(spark, sf), head.class_matrix(_centroids(spark, sf))
    model = fit.ArcHead(
        n_classes=start.shape[0], dim=start.shape[1], epochs=4, lr=0.05, dropout=0.0, log_every=1
    ).fit(rows, init=start)
    return model.history_table(spark).select(
        "step", r6("loss").alias("loss"), r6("accuracy").alias("accuracy"), (F.round(F.col("rate") * 1e6, 6) + 0.0).alias("rate")
    )


@query
def fit_resumed(spark, sf):
    """The same fit broken off after two steps, saved, read back and gone on with: the losses of its later steps."""
    rows, start = vectors(spark, sf), head.class_matrix(_centroids(spark, sf))
    path = scratch(spark)
    made = lambda: fit.ArcHead(
        n_classes=start.shape[0], dim=start.shape[1], epochs=4, lr=0.05, dropout=0.0, log_every=1, save_every=2
    )
    made().fit(rows, init=start, save_path=path)
    resumed = made().fit(rows, init=load_head(spark, path, 2))
    return resumed.history_table(spark).select(
        "step", r6("loss").alias("loss"), (F.round(F.col("rate") * 1e6, 6) + 0.0).alias("rate")
    )


@query
def fit_step_sharded(spark, sf):
    """The same step with the classes in shards of three."""
    rows, start = vectors(spark, sf), sharded.sharded_state(_centroids(spark, sf))
    state, _ = sharded.sharded_step(rows, start, 0, 0.05, shards=max(1, start.count() // 3))
    return long_form(state.withColumnRenamed("class", "id"), "id", "w")


@query
def eval_head_sharded(spark, sf):
    state = sharded.sharded_state(_centroids(spark, sf))
    found = sharded.sharded_evaluate(vectors(spark, sf), state, "id", batch_size=128, shards=max(1, state.count() // 3))
    return found.select("n", *[r6(c).alias(c) for c in found.columns if c != "n"])


@query
def learning_rate(spark, sf):
    """The rates that a whole fit over the vectors used, in millionths."""
    rows = vectors(spark, sf)
    size = rows.agg(F.max("label").alias("top"), F.max(F.size("embedding")).alias("dim")).first()
    model = fit.ArcHead(n_classes=size["top"] + 1, dim=size["dim"], epochs=8, log_every=1).fit(rows)
    history = model.history_table(spark)
    return history.select((F.col("step") - 1).alias("step"), (F.round(F.col("rate") * 1e6, 9) + 0.0).alias("rate"))


@query
def saved_head(spark, sf):
    """Centroids saved as a head and read back."""
    path = scratch(spark)
    save_head(spark, fit.HeadState(head.class_matrix(_centroids(spark, sf)), step=100), path)
    state = load_head(spark, path)
    return long_form(fit.ArcHeadModel(state).weight_table(spark).withColumnRenamed("class", "id"), "id", "w")


# Search, lists, records


@query
def knn_self(spark, sf):
    found = neighbours.knn(vectors(spark, sf))
    return found.withColumn("d2", r6("d2"))


@query
def knn_drop_first(spark, sf):
    found = neighbours.knn(vectors(spark, sf), drop="first")
    return found.withColumn("d2", r6("d2"))


@query
def knn_blocks(spark, sf):
    """The same search through cells and blocks."""
    found = neighbours.knn(vectors(spark, sf), block_rows=200)
    return found.withColumn("d2", r6("d2"))


@query
def knn_cross(spark, sf):
    """Class centroids searched against all vectors."""
    asked = _centroids(spark, sf).select(F.col("class").alias("id"), F.col("w").alias("embedding"))
    found = neighbours.knn(asked, vectors(spark, sf), k=13, drop=None)
    return found.withColumn("d2", r6("d2"))


@query
def knn_tree(spark, sf):
    """The same search through a tree of cells."""
    found = neighbours.knn(vectors(spark, sf), block_rows=64, tree=True)
    return found.withColumn("d2", r6("d2"))


@query
def knn_tree_cross(spark, sf):
    """Class centroids searched in a tree of all vectors."""
    centroids = _centroids(spark, sf).select(F.col("class").alias("id"), F.col("w").alias("embedding"))
    found = neighbours.knn(centroids, vectors(spark, sf), k=13, drop=None, block_rows=64, tree=True)
    return found.withColumn("d2", r6("d2"))


@query
def knn_cosine(spark, sf):
    moved = F.transform("embedding", lambda v: (v + 0.25) * (F.col("label") + 1))
    found = neighbours.knn(vectors(spark, sf).withColumn("embedding", moved), metric="cosine")
    return found.withColumn("d2", r6("d2"))


def _scaled(spark, sf, factor, **options):
    stretched = F.transform("embedding", lambda v: v.cast("double") * factor)
    found = neighbours.knn(vectors(spark, sf).withColumn("embedding", stretched), **options)
    return found.withColumn("d2", r6(F.col("d2") / factor / factor))


@query
def knn_small(spark, sf):
    return _scaled(spark, sf, 1e-6)


@query
def knn_small_blocks(spark, sf):
    return _scaled(spark, sf, 1e-6, block_rows=200)


@query
def knn_large(spark, sf):
    return _scaled(spark, sf, 1e20)


@query
def knn_large_blocks(spark, sf):
    return _scaled(spark, sf, 1e20, block_rows=200)


def _two_names(spark, sf, **options):
    names = read_catalogue(table(spark, sf, "part"), "p_brand", "p_name", None)
    rows = embed(names, "id", "name", lambda: HashingEncoder(ENCODER_DIM), ENCODER_DIM)
    found = neighbours.knn(durable(rows.select("id", "embedding")), **options)
    return found.withColumn("d2", r6("d2"))


@query
def knn_two_names(spark, sf):
    """Ids with many names: each name's list has different ids only."""
    return _two_names(spark, sf)


@query
def knn_two_names_blocks(spark, sf):
    return _two_names(spark, sf, block_rows=50)


@query
def knn_short(spark, sf):
    """All vectors against the few class centroids: lists shorter than k."""
    items = _centroids(spark, sf).select(F.col("class").alias("id"), F.col("w").alias("embedding"))
    found = neighbours.knn(vectors(spark, sf), items, drop=None)
    return found.withColumn("d2", r6("d2"))


@query
def list_purity(spark, sf):
    rows = vectors(spark, sf)
    found = compare.purity(neighbours.knn(rows), rows.select("id", "label"))
    return found.withColumn("purity", r6("purity"))


@query
def knn_names(spark, sf):
    """Names with many equal vectors, so that ties decide."""
    names = read_catalogue(table(spark, sf, "part"), "p_partkey", "p_name", None)
    rows = embed(names, "id", "name", lambda: HashingEncoder(ENCODER_DIM), ENCODER_DIM)
    found = neighbours.knn(durable(rows.select("id", "embedding")))
    return found.withColumn("d2", r6("d2"))


@query
def list_texts(spark, sf):
    return neighbour_lists(neighbours.knn(vectors(spark, sf)))


def _records(spark, sf):
    now = F.lit(NOW).cast("timestamp")
    lists = neighbour_lists(neighbours.knn(vectors(spark, sf)))
    return R.latest(R.records(lists, "deep", now))


@query
def publish_records(spark, sf):
    return _records(spark, sf).select(
        "key", "value", F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss").alias("expires_at")
    )


@query
def publish_run(spark, sf):
    """Two models and two runs publish to one folder; a reader of the compacted folder sees what is live."""
    now = F.lit(NOW).cast("timestamp")
    lists = durable(neighbour_lists(neighbours.knn(vectors(spark, sf))))
    path, later = scratch(spark), scratch(spark)
    for model, days in (("old", 8), ("deep", 8), ("deep", 1)):
        R.publish(lists, model, now - F.make_dt_interval(days=F.lit(days)), path=path)
    R.compact(spark, path, later, now)
    return R.live(spark.read.parquet(later), now).select("key", "value")


@query
def published_batches(spark, sf):
    """Records handed to an external writer in batches: what its files hold."""
    path = scratch(spark)
    spark.range(1).write.parquet(path)  # the store's folder

    def open_store():
        import pyarrow.fs as pafs

        store, folder = pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)

        def write(rows):
            with store.open_output_stream(f"{folder}/{uuid.uuid4().hex}.txt") as out:
                out.write("".join(f"{key}\t{value}\n" for key, value, _ in rows).encode())

        return write

    lists = neighbour_lists(neighbours.knn(vectors(spark, sf)))
    R.publish(lists, "deep", F.lit(NOW).cast("timestamp"), writer=open_store, batch=64)
    line = F.split("value", "\t")
    return spark.read.text(f"{path}/*.txt").select(line[0].alias("key"), line[1].alias("value")).distinct()


@query
def live_records(spark, sf):
    """Every event as a write to the key of its user and type: the last wins, some have expired."""
    events = table(spark, sf, "events").select(
        F.concat_ws(":", "user_id", "event_type").alias("key"),
        F.col("event_id").cast("string").alias("value"),
        F.col("ts").alias("written_at"),
        (F.col("ts") + F.make_dt_interval(secs=F.lit(7 * 24 * 3600))).alias("expires_at"),
    )
    return R.live(events, F.lit(NOW).cast("timestamp")).select("key", "value")


# What is kept up from run to run


def _snapshots(spark, sf):
    """The documents' texts and sources under their ids, before and after: some come, some go, some change."""
    docs = table(spark, sf, "documents")
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("name"), "lang").unionByName(
        docs.select(F.col("doc_id").alias("id"), F.expr("nullif(source, 'src0')").alias("name"), "lang")
    )
    before = rows.where("lang <> 'de'").select("id", "name")
    again = F.when(F.col("lang") == "fr", F.upper("name")).otherwise(F.col("name")).alias("name")
    after = rows.where("lang <> 'es'").select("id", again)
    return before.union(before), after.union(after.limit(1).select(F.lit(None).cast("long"), "name"))


@query
def snapshot_difference(spark, sf):
    before, after = _snapshots(spark, sf)
    return difference(fingerprints(before), fingerprints(after))


@query
def vectors_kept(spark, sf):
    """Encoded in two runs, the second of which finds the first one's vectors stored."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    shelf, result = Shelf(spark, scratch(spark)), None
    for rows in (docs.where("lang <> 'en'"), docs):
        result = embed_stored(rows.select("id", "text"), "id", "text", lambda: HashingEncoder(ENCODER_DIM), ENCODER_DIM, shelf, "hash")
    return long_form(result, "id", "embedding")


@query
def lists_repaired(spark, sf):
    """Lists after some vectors have moved, some are new and some are gone: repaired ones beside untouched ones."""
    rows = vectors(spark, sf)
    flipped = F.transform("embedding", lambda v: -v)
    before = durable(rows.where("label <> 1").select("id", "embedding"))
    lists = durable(neighbours.knn_lists(before))
    changed = rows.where("label = 1").select("id", "embedding").unionByName(
        rows.where("label = 2").select("id", flipped.alias("embedding"))
    )
    gone = rows.where("label = 3").select("id")
    touched = durable(repaired_lists(before, lists, changed, gone, block_rows=64))
    kept = lists.join(touched, "id", "left_anti").join(gone, "id", "left_anti")
    found = kept.unionByName(touched.select("id", "neighbours"))
    return found.select("id", F.posexplode("neighbours").alias("p", "n")).select(
        "id", "n.neighbour_id", r6("n.d2").alias("d2"), (F.col("p") + 1).alias("rank")
    )


def _catalogue_days(spark, sf):
    """A catalogue that changes twice: first some products go, then others get another name."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_type")
    left = parts.where("p_type <> 'ECONOMY'")
    renamed = F.when(F.col("p_type") == "PROMO", F.concat("name", F.lit(" small"))).otherwise(F.col("name"))
    return [d.select("id", "name") for d in (parts, left, left.withColumn("name", renamed))]


@query
def daily_runs(spark, sf):
    """Three daily runs on one shelf; its records are those of a whole run on the last day."""
    shelf = Shelf(spark, scratch(spark), buckets=8)
    for day, catalogue in enumerate(_catalogue_days(spark, sf)):
        run_snapshot(shelf, catalogue, lambda: HashingEncoder(ENCODER_DIM), "hash", F.lit(NOW).cast("timestamp"), ENCODER_DIM, tag=day)
    return shelf.read("records").select("key", "value")


@query
def stream_publish(spark, sf):
    """The same changes as files that a stream picks up one by one, one of them a second time."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_type")
    drops = [
        parts.select("id", "name", F.lit("UP").alias("status"), F.lit(1).alias("at")),
        parts.where("p_type = 'ECONOMY'").select("id", "name", F.lit("DOWN").alias("status"), F.lit(2).alias("at")),
        parts.where("p_type = 'PROMO'").select("id", F.concat("name", F.lit(" small")).alias("name"), F.lit("UP").alias("status"), F.lit(3).alias("at")),
    ]
    source, shelf, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    for drop in drops:
        drop.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(drops[0].schema).option("maxFilesPerTrigger", 1).parquet(source)
        publish_stream(
            stream, shelf, checkpoint, lambda: HashingEncoder(ENCODER_DIM), "hash", F.lit(NOW).cast("timestamp"), ENCODER_DIM
        ).awaitTermination()
    return Shelf(spark, shelf).read("records").select("key", "value")


# Runs and comparison


@query
def deep_lists_names(spark, sf):
    catalogue = read_catalogue(table(spark, sf, "part"), "p_partkey", "p_name", "p_type", "ECONOMY")
    lists, _ = deep_lists(catalogue, lambda: HashingEncoder(ENCODER_DIM), ENCODER_DIM)
    return lists


@query
def baseline_lists_names(spark, sf):
    catalogue = read_catalogue(table(spark, sf, "part"), "p_partkey", "p_name", "p_type", "ECONOMY")
    words = word_vectors(clean.tokenize(catalogue, "name"), WORD_DIM_NAMES)
    lists, _ = baseline_lists(catalogue, words, ["small"], dim=WORD_DIM_NAMES)
    return lists


@query
def run_summary_baseline(spark, sf):
    parts = table(spark, sf, "part").withColumn("name", F.expr("nullif(p_name, 'small ring')"))
    catalogue = read_catalogue(parts, "p_partkey", "name", "p_type", "ECONOMY")
    words = word_vectors(clean.tokenize(catalogue, "name"), WORD_DIM_NAMES)
    counts = RunCounts()
    for result in baseline_lists(catalogue, words, dim=WORD_DIM_NAMES, counts=counts):
        result.write.format("noop").mode("overwrite").save()
    return counts.summary(spark, parts=("embedded", "rejected"))


@query
def run_summary(spark, sf):
    parts = table(spark, sf, "part").withColumn("name", F.expr("nullif(p_name, 'small ring')"))
    catalogue = read_catalogue(parts, "p_partkey", "name", "p_type", "ECONOMY")
    counts = RunCounts()
    lists, rejects = deep_lists(
        catalogue, lambda: HashingEncoder(ENCODER_DIM), ENCODER_DIM, counts=counts
    )
    for result in (lists, rejects):
        result.write.format("noop").mode("overwrite").save()
    return counts.summary(spark, parts=("embedded", "rejected"))


@query
def train_head_run(spark, sf):
    """Labelled files to a saved head: the counts of a whole training run, read back from its folder."""
    files, saved = scratch(spark), scratch(spark)
    lines = labelled_lines(spark, sf, ",", False)
    lines.write.option("header", True).option("quote", "").option("sep", "\x01").csv(files)
    run = train_head(
        spark, files, lambda: HashingIdEncoder(ENCODER_DIM), ENCODER_DIM, n_classes=2, dev_path=files,
        save_path=saved, epochs=2, lr=0.05, save_every=2, log_every=1,
    )
    vocab = spark.read.parquet(f"{saved}/vocab/step=2")
    state = load_head(spark, saved, 2)
    evaluated = [h for h in run.model.history if "dev_loss" in h]
    return run.counts.select("loaded", "rejected", "embedded", "balanced").withColumns(
        {
            "words": F.lit(vocab.count()),
            "reject_rows": F.lit(run.rejects.count()),
            "saved_values": F.lit(int(state.weights.size)).cast("bigint"),
            "evaluations": F.lit(len(evaluated)).cast("bigint"),
        }
    )


@query
def list_overlap(spark, sf):
    """Lists by distance against lists by angle of shifted vectors."""
    moved = F.transform("embedding", lambda v: (v + 0.25) * (F.col("label") + 1))
    rows = vectors(spark, sf)
    other = rows.withColumn("embedding", V.l2_normalise(moved))
    found = compare.overlap(neighbours.knn(rows), neighbours.knn(other))
    return found.select(
        "id", "n_shared", r6("overlap").alias("overlap"), r6("jaccard").alias("jaccard"), "first_diff"
    )


@query
def arm_metrics(spark, sf):
    found = compare.arm_metrics(table(spark, sf, "events"))
    return found.withColumn("mean_value", r6("mean_value"))
