"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the smallest node of the neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour smaller than a node, and the node, are tied to the smallest of them. Here a > b in every edge."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component for every node of ``edges`` (a, b; long): the component is its smallest node.

    Minima are combined on the map side; the joins have one row per node on one side, so a node with very many edges
    is split by adaptive execution. Loops, repeated edges and nulls are dropped; no edges: no rows. Each round is a
    table in the shared folder. The rounds grow with the logarithm of the longest path.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                     "edges")
    seen = None
    for _ in range(rounds):
        current = stored(_small_star(_large_star(current).distinct()).distinct(), "edges")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == seen:
            stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
