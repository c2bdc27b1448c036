"""Connected components by alternating star contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import stored


def _around(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours (its larger ones, or its smaller ones) linked to the least of node and neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # The grouped minimum is combined before the shuffle; a hub's rows stay spread in the join.
    linked = both.join(least, "a")
    out = linked.filter("b > a") if larger else linked
    out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not larger:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of the nodes of ``edges`` (a, b); root is the least node that can be reached.

    Ends when a round changes nothing, after about the logarithm of the longest
    path; every round is written to shared scratch. Loops and repeated edges do
    no harm. Without edges the result is empty.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        new = stored(_around(_around(edges, True), False), "edges")
        # Stars whose centres are the least of all they reach no longer change.
        centres = new.select(F.col("b").alias("a")).distinct()
        settled = new.join(centres, "a", "left_semi").isEmpty() and new.groupBy("a").count().filter("count > 1").isEmpty()
        edges = new
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
