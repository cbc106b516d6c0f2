"""Catalogue tables: products on the shelf, one row per (id, name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.constants import ON_SHELF
from vecshelf.operators.clean import split_rejects


def read_catalogue(
    source: DataFrame | str,
    id: str = "spu_sn",
    name: str = "spu_name",
    status: str | None = "status",
    up: str = ON_SHELF,
    one_row_per_id: bool = False,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Distinct `(id, name)` of the rows whose status is `up`, from a frame or a table name.

    With `one_row_per_id`, an id with several names keeps the smallest.
    """
    df = (spark or SparkSession.active()).table(source) if isinstance(source, str) else source
    if status is not None:
        df = df.where(F.col(status) == up)
    rows = df.select(F.col(id).alias("id"), F.col(name).alias("name"))
    if one_row_per_id:
        return rows.groupBy("id").agg(F.min("name").alias("name"))
    return rows.distinct()


def named(catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an id and a name, and rejects for those without."""
    checks = {"null_id": F.col("id").isNull(), "null_name": F.col("name").isNull()}
    return split_rejects(catalogue, "id", "name", checks)
