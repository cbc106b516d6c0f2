"""Word lists and word vectors from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stopwords(spark: SparkSession, path: str, strip: bool = False) -> DataFrame:
    """`(stopword)`: the first tab-separated field of each non-blank line, blanks kept."""
    word = F.element_at(F.split("value", "\t"), 1)
    words = spark.read.text(path).where(F.length("value") > 0).select(
        (F.trim(word) if strip else word).alias("stopword")
    )
    return words.where(F.length("stopword") > 0)


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """`(token, vec)` from the text form of word vectors: `token v1 v2 ...` on each line.

    The leading `count dim` line, if there, is told apart by its two fields.
    """
    parts = F.split(F.rtrim("value"), " ")
    return (
        spark.read.text(path)
        .select(parts.alias("p"))
        .where(F.size("p") > 2)
        .select(
            F.element_at("p", 1).alias("token"),
            F.slice("p", F.lit(2), F.size("p") - 1).cast("array<float>").alias("vec"),
        )
    )
