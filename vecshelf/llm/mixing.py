"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

A source's weight is the integral of its weight schedule over the run. Targets share out the
wanted number of words by weight, with a limit on repeats. Within a source documents follow in a
fixed random order; each copy of a document has a place in its source's cumulative demand, and the
inverse of that demand gives its training position.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecshelf.llm.common import WORD, fresh, text_of
from vecshelf.session import durable

Schedule = Sequence[tuple[float, float]]  # (share of the run from 0 to 1, weight), linear between

#: Dealt to the sources in code point order, again and again. The integrals are 5, 2 and 1.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 6.0), (1.0, 4.0)),
    ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
BUCKET_ROWS = 1 << 15  # rows of all sources behind one value of the first digits of the order


def integral(schedule: Schedule) -> float:
    return sum((v + w) / 2 * (y - x) for (x, v), (y, w) in zip(schedule, schedule[1:]))


def inverse_demand(schedule: Schedule, share: Column) -> Column:
    """When the integral of `schedule` reaches `share` of its whole."""
    whole, done, cases = integral(schedule), 0.0, None
    for (x, v), (y, w) in zip(schedule, schedule[1:]):
        part = (v + w) / 2 * (y - x)
        slope = (w - v) / (y - x)
        need = F.greatest(share * whole - done, F.lit(0.0))
        # The root of v t + slope t^2 / 2 = need, in the form that also holds for slope 0.
        root = v + F.sqrt(F.greatest(v * v + 2 * slope * need, F.lit(0.0)))
        at = F.least(x + F.when(root > 0, 2 * need / root).otherwise(0.0), F.lit(y))
        done += part
        cases = (F.when if cases is None else cases.when)(share * whole <= done, at)
    return cases.otherwise(schedule[-1][0])


def source_targets(
    sums: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = TOTAL_SHARE, repeats: int = MAX_REPEATS
) -> DataFrame:
    """Add `rank`, `target` and `whole` (all targets) to a table (source, source_size), one row per source.

    Targets are min(repeats * size, level * weight) with the one level at which they add up to
    `share` of all sizes: what a limited source cannot take is shared again by weight. The level is
    found in one pass over the sources in the order in which they reach their limits.
    """
    weights = [integral(s) for s in schedules]
    ranked = sums.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("rank", F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(repeats))
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(Window.partitionBy(F.lit(1))) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / F.sum("weight").over(from_here)
    levels = ranked.withColumn("level", level).withColumn("place", F.row_number().over(order))
    reached = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct("place", "level"))
    chosen = F.min(reached).over(Window.partitionBy(F.lit(1)))["level"]
    target = F.least("most", chosen * F.col("weight"))
    whole = F.sum("source_size").over(Window.partitionBy(F.lit(1))) * float(min(share, repeats))
    return levels.select("source", "source_size", "rank", target.alias("target"), whole.alias("whole"))


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = TOTAL_SHARE,
    repeats: int = MAX_REPEATS,
    seed: str = "mix",
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, positions.

    `size` counts words; a null or empty text has none and is taken zero times in effect. `taken` is
    the words taken, repeats counted; `positions` lists, for each copy taken, its place among the
    words of the whole run (ascending). A source takes whole passes of all its documents and one
    more pass over a part, which ends where the sum comes nearest to the target: the difference is at most half a
    document. The order within a source is by md5 of seed and id, so reruns agree; rows with equal or
    null ids are told apart by size only. A null source is a source of its own. Extra columns are
    not read; an empty table gives an empty result.
    """
    key = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    sized = durable(
        docs.select(
            F.col(id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
            key.alias("key"),
        )
    )
    digits = max(2, math.ceil(math.log(max(1, sized.count()) / BUCKET_ROWS, 16)))
    bucketed = sized.withColumn("bucket", F.substring("key", 1, digits))
    # Running sums in two steps, so that no source, however large, is one window.
    buckets = durable(bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")))
    targets = source_targets(
        buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), schedules, share, repeats
    )
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(
        "source", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("start")
    ).alias("b").join(targets.alias("t"), F.expr("b.source <=> t.source")).select("b.*", "source_size", "rank", "target", "whole")
    rows = bucketed.alias("d").join(
        starts.alias("s"), F.expr("d.source <=> s.source and d.bucket = s.bucket")
    ).select("d.*", "start", "source_size", "rank", "target", "whole")
    inside = (
        Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("passes", passes.cast("int"))
    left = F.col("target") - F.col("passes") * F.col("source_size")
    more = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= left)
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, F.col("passes") + more.cast("int")).otherwise(0))
    middle = F.col("before") + F.col("size") / 2
    places = F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1),
        lambda k: F.least((k * F.col("source_size") + middle) / F.col("target"), F.lit(1.0)),
    )
    at = F.transform("places", lambda f: _position(schedules, F.col("rank"), f) * F.col("whole"))
    rows = rows.withColumn("places", F.when(F.col("copies") > 0, places).otherwise(F.array().cast("array<double>")))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.array_sort(at).alias("positions"),
    )


def _position(schedules: Sequence[Schedule], rank: Column, share: Column) -> Column:
    kind = F.pmod(rank, F.lit(len(schedules)))
    cases = F.when(kind == 0, inverse_demand(schedules[0], share))
    for i, schedule in enumerate(schedules[1:], 1):
        cases = cases.when(kind == i, inverse_demand(schedule, share))
    return cases


def training_order(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of `docs`, one for each copy that the mix takes, range-sorted by training position.

    Documents that the mix does not take go, those without a word among them. Rows that share an id are repeated as often as
    the first of them; null ids are one id. Columns are those of `docs`, whatever their names. An empty table gives an
    empty result.
    """
    id_name, places, place = (fresh(docs, name) for name in ("_mixed_id", "_positions", "_position"))
    plan = mixed(docs, id, text, source, **options).where("taken > 0")
    copies = plan.groupBy(F.col("doc_id").alias(id_name)).agg(F.max("positions").alias(places))
    rows = docs.join(copies, F.col(id).eqNullSafe(F.col(id_name)))
    return (
        rows.withColumn(place, F.explode(places))
        .orderBy(place, id)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
