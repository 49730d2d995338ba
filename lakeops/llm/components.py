"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and two joins over the edges, so no task or
driver ever holds a component; each round's edges are written to the shared
folder, which keeps the plan short and lets a lost executor resume from there.
The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the node's smallest."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("x"), F.col("m").alias("y"))
            .where("x <> y").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them.  Edges: x > y."""
    least = edges.groupBy("x").agg(F.min("y").alias("m"))
    moved = edges.join(least, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
    return moved.union(least.select("x", F.col("m").alias("y"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root: its component's smallest node."""
    edges = materialise(links.select("a", "b").where("a <> b"), "components-0")
    seen = None
    for i in range(1, 100):
        stars = materialise(_small_star(_large_star(edges)), f"components-{i}")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, edges = state, stars.select(F.col("x").alias("a"), F.col("y").alias("b"))
    else:
        raise RuntimeError("components did not converge")
    return stars.select(F.col("x").alias("node"), F.col("y").alias("root")).union(
        stars.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())
