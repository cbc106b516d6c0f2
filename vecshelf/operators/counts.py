"""Row counts of the stages of one run, taken while the run's own job passes over the rows."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunCounts:
    """Counts rows per stage without extra jobs.

    `watch` marks a stage; after an action on the marked frames, `summary` gives one row with a
    column per stage and the balance check.
    """

    def __init__(self, wait_s: float = 30.0):
        self._wait_s = wait_s
        self._stages: dict[str, Observation] = {}

    def watch(self, stage: str, df: DataFrame) -> DataFrame:
        if stage in self._stages:
            raise ValueError(f"stage {stage} is watched already")
        seen = Observation(stage)
        self._stages[stage] = seen
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def counts(self) -> dict[str, int]:
        return {stage: self._count(stage, seen) for stage, seen in self._stages.items()}

    def _count(self, stage: str, seen: Observation) -> int:
        """The count, once the stage's job is done; an error if no job ran over it."""
        found: list[int] = []
        waiting = threading.Thread(target=lambda: found.append(seen.get["n"]), daemon=True)
        waiting.start()
        waiting.join(self._wait_s)
        if not found:
            raise RuntimeError(f"no finished job has passed over stage {stage}")
        return found[0]

    def summary(
        self, spark: SparkSession, whole: str = "loaded", parts: tuple[str, ...] = ("cleaned", "rejected")
    ) -> DataFrame:
        """One row of counts; `balanced` says whether the parts add up to the whole."""
        counts = self.counts()
        balanced = counts[whole] == sum(counts[p] for p in parts)
        schema = ", ".join([*(f"{s} bigint" for s in counts), "balanced boolean"])
        return spark.createDataFrame([(*counts.values(), balanced)], schema)

    def check(self, whole: str = "loaded", parts: tuple[str, ...] = ("cleaned", "rejected")) -> None:
        counts = self.counts()
        if counts[whole] != sum(counts[p] for p in parts):
            raise ValueError(f"rows lost or doubled: {counts}")
