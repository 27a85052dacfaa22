"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node itself, are linked to its least neighbour."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    lower = edges.join(least, "b").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return lower.union(least.select(F.col("least").alias("a"), "b")).where("a < b").distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node that it reaches.

    Each round is a written table; rounds grow with the logarithm of the longest path. Only a count and a
    checksum of the links reach the driver.
    """
    now = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
                 f"{label}-edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        now = settle(_small_star(_large_star(now)), f"{label}-stars")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
