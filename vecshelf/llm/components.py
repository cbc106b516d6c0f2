"""Connected components of an edge table by repeated random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshelf.session import durable

MAX_ROUNDS = 200  # each round removes a constant share of the nodes, so this is never reached


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Return (node, component) for every node with an edge; the component is its smallest node.

    In each round every node joins the neighbour (or itself) with the smallest random number of that
    round, and edges inside one class go. Long paths shrink as fast as stars. Classes of all rounds
    are then chained. Edges and classes are written tables: they never pass through the driver, and
    a lost executor costs its tasks only. Rows with a null end and loops are left out; an empty
    table gives an empty result.
    """
    left = F.least(F.col(a), F.col(b)).alias("a")
    right = F.greatest(F.col(a), F.col(b)).alias("b")
    rest = durable(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(left, right).distinct()
    )
    classes = None
    for round_ in range(MAX_ROUNDS):
        if rest.isEmpty():
            break
        step = durable(_nearest(rest, round_))
        rest = durable(_contracted(rest, step))
        if classes is None:
            classes = step
        else:
            later = step.select(F.col("node").alias("rep"), F.col("rep").alias("next"))
            classes = classes.join(later, "rep", "left").select("node", F.coalesce("next", "rep").alias("rep"))
    else:
        raise RuntimeError("components did not settle")
    if classes is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    classes = durable(classes)
    smallest = classes.groupBy("rep").agg(F.min("node").alias("component"))
    return classes.join(smallest, "rep").select("node", "component")


def _nearest(edges: DataFrame, round_: int) -> DataFrame:
    def drawn(node):
        return F.struct(F.xxhash64(F.lit(round_), node).alias("draw"), node.alias("node"))

    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    best = ends.groupBy("node").agg(F.min(drawn(F.col("other"))).alias("best"))
    return best.select("node", F.least("best", drawn(F.col("node")))["node"].alias("rep"))


def _contracted(edges: DataFrame, step: DataFrame) -> DataFrame:
    ends = edges.join(step.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a")
    ends = ends.join(step.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b")
    return (
        ends.where("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
    )
