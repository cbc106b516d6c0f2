"""Saved heads: one folder per step, and the vocabulary beside it."""

from __future__ import annotations

import logging

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshelf.operators.fit import HeadState

log = logging.getLogger(__name__)

_SCHEMA = "name string, row bigint, values array<double>"
_PARTS = {"weight": "weights", "moment1": "first", "moment2": "second"}


def save_head(
    spark: SparkSession, state: HeadState, path: str, vocab: DataFrame | None = None
) -> None:
    """Write the state under `step=<n>`; saving one step twice replaces it."""
    rows = [
        (name, j, [float(v) for v in w])
        for name, attribute in _PARTS.items()
        for j, w in enumerate(getattr(state, attribute))
    ]
    spark.createDataFrame(rows, _SCHEMA).write.mode("overwrite").parquet(
        f"{path}/state/step={state.step}"
    )
    if vocab is not None:
        vocab.write.mode("overwrite").parquet(f"{path}/vocab/step={state.step}")


def load_head(
    spark: SparkSession, path: str, step: int | None = None, missing: str = "warn"
) -> HeadState | None:
    """The state saved at `step`, or at the last step. None if there is none (`missing="warn"`)."""
    try:
        saved = spark.read.parquet(f"{path}/state")
        if step is None:
            step = saved.agg(F.max("step").alias("step")).first()["step"]
        rows = saved.where(F.col("step") == step).select("name", "row", "values").collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) or missing == "fail":
            raise
        rows = []
    if not rows:
        if missing == "fail":
            raise FileNotFoundError(f"no saved head in {path}")
        log.warning("no saved head in %s, going on without", path)
        return None
    parts = {
        attribute: np.array([r["values"] for r in sorted(
            (r for r in rows if r["name"] == name), key=lambda r: r["row"]
        )])
        for name, attribute in _PARTS.items()
    }
    return HeadState(step=int(step), **parts)
