"""What the physical plans must look like."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from vecshelf.operators import clean, encode
from vecshelf.operators.lookup import lookup_join
from vecshelf.session import durable, owned, shared_folder, spread
from vecshelf.sources.catalogue import read_catalogue

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_catalogue_scan_is_pruned_and_filtered(spark):
    df = read_catalogue(spark.read.parquet(f"{SF}/part.parquet"), "p_partkey", "p_name", "p_type", "ECONOMY")
    text = plan(df)
    assert "EqualTo(p_type,ECONOMY)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string>" in text
    assert text.count("Exchange hashpartitioning") <= 2  # initial plan may be printed too


def test_cleaning_stays_in_the_jvm_without_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(clean.clean_baseline(docs, "text", ["the"]).select("doc_id", "clean"))
    assert "Exchange" not in text
    assert "Python" not in text and "Arrow" not in text
    assert "n_chars" not in text


def test_small_vocabulary_needs_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tokens = clean.tokenize(docs, "text")
    vocab = spark.createDataFrame([("the", 4)], "token string, id bigint")
    text = plan(encode.encode(tokens, "doc_id", "tokens", vocab, max_seq_len=8))
    assert "Exchange" not in text


def test_copies_are_limited_before_the_shuffle(spark):
    from vecshelf.operators import neighbours

    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = neighbours.knn(rows, k=3, id="vec_id")
    assert "WindowGroupLimit" in plan(found)


def test_lookup_broadcasts_hot_keys_without_a_one_task_limit(spark):
    left = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    right = left.select("text").distinct().withColumn("v", F.lit(1))
    text = plan(lookup_join(left, right, "text", spread=["doc_id"]))
    assert "BroadcastHashJoin" in text and "Limit" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_durable_is_a_table_in_the_shared_folder(spark):
    df = durable(spark.range(10).withColumn("x", F.lit(1)))
    assert "vecshelf-" in plan(df.select("id"))
    assert "ReadSchema: struct<id:bigint>" in plan(df.select("id"))
    assert spark.conf.get("spark.checkpoint.dir") in shared_folder(spark)


def test_spread_leaves_large_scans_alone(spark):
    scan = spark.read.parquet(f"{SF}/documents.parquet")
    assert spread(scan).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 16)
    assert spread(many) is many


def test_owned_folders_go_with_their_block(spark):
    with owned(spark):
        inside = durable(spark.range(3))
        assert inside.count() == 3
        path = inside.inputFiles()[0].rpartition("/")[0]
    assert not os.path.exists(path.removeprefix("file://"))
