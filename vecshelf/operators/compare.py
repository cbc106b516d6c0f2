"""Comparing two models: agreement of their lists, and figures per test arm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.constants import NEIGHBOURS
from vecshelf.functions.text import hash_number


def overlap(a: DataFrame, b: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """Per id in both: shared neighbours, their share of `k`, Jaccard, first differing rank.

    `a` and `b` are `(id, neighbour_id, rank)`. `first_diff` is NULL when the lists are equal.
    """

    def lists(df: DataFrame, out: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("rank", "neighbour_id")))
        return df.where(F.col("rank") <= k).groupBy("id").agg(
            F.transform(ordered, lambda x: x["neighbour_id"]).alias(out)
        )

    both = lists(a, "_a").join(lists(b, "_b"), "id")
    shared = F.size(F.array_intersect("_a", "_b")).cast("bigint")
    union = F.size(F.array_union("_a", "_b"))
    same = F.zip_with("_a", "_b", lambda x, y: F.coalesce(x == y, F.lit(False)))
    differ = F.array_position(same, F.lit(False))
    return both.select(
        "id",
        shared.alias("n_shared"),
        (shared / F.lit(k)).alias("overlap"),
        (shared / union).alias("jaccard"),
        F.when(differ > 0, differ).alias("first_diff"),
    )


def purity(neighbours: DataFrame, labels: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """`(id, purity)`: the share of an id's first `k` neighbours that carry its own label.

    `neighbours` is `(id, neighbour_id, rank)`, `labels` is `(id, label)` with one row per id. Neighbours
    without a label count as different; ids without one are left out.
    """
    own = labels.where("label is not null")
    asked = neighbours.where(F.col("rank") <= k).join(own, "id")
    theirs = own.select(F.col("id").alias("neighbour_id"), F.col("label").alias("_theirs"))
    found = asked.join(theirs, "neighbour_id", "left")
    same = F.coalesce(F.col("label") == F.col("_theirs"), F.lit(False)).cast("int")
    return found.groupBy("id").agg(F.avg(same).alias("purity"))


def arm_metrics(
    events: DataFrame,
    arms: int = 2,
    user: str = "user_id",
    kind: str = "event_type",
    value: str = "value",
    salt: str = "ab",
) -> DataFrame:
    """Per test arm and event type: events, users and mean value. A user's arm is a hash bucket."""
    arm = F.pmod(hash_number(F.lit(salt), F.col(user)), F.lit(arms))
    # Users are counted by grouping twice, so that no task holds all users of an arm.
    per_user = events.groupBy(arm.alias("arm"), F.col(kind).alias("event_type"), user).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("v"), F.count(value).alias("nv")
    )
    return per_user.groupBy("arm", "event_type").agg(
        F.sum("n").alias("events"),
        F.count(user).alias("users"),
        (F.sum("v") / F.sum("nv")).alias("mean_value"),
    )
