"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import by_shuffle, stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``edges`` (a, b: bigint). Loops and repeated edges do no harm.

    Each round links every node to the smallest of its neighbours, first those above it, then those below; the number of rounds grows
    with the logarithm of the longest path, and every step is an aggregation with partial minima and a join, so that hubs do not gather
    in one task.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    rows = now.count()
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.where("b > a").join(by_shuffle(least, 2 * rows), "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # large: every greater neighbour of a node now points to the node's least neighbour
        below = large.union(least.where("low < a").select("a", F.col("low").alias("b"))).where("a <> b").distinct()
        low = below.groupBy("a").agg(F.min("b").alias("low"))
        small = below.join(by_shuffle(low, 2 * rows), "a").where("b <> low").select("b", "low").union(low.select("a", "low")).toDF("a", "b")
        after = stored(small.distinct(), "edges")
        rows = after.count()
        if _settled(after, rows):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(after.select("b", "b").distinct())
        now = after
    raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")


def _settled(edges: DataFrame, rows: int) -> bool:
    """True if every node points to one root and no root points anywhere: the edges are stars around the smallest node."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
    chained = edges.join(by_shuffle(edges.select(F.col("a").alias("b")).distinct(), rows), "b", "left_semi").limit(1)
    return several.isEmpty() and chained.isEmpty()
