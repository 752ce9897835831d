"""Connected components of a graph given as edges, by alternating star contractions.

Every round points the larger neighbours of each node at its smallest neighbour, then the smaller ones; a component becomes a star around its
smallest node after a number of rounds that grows with the logarithm of its size (Kiveris and others, "Connected Components in MapReduce and
Beyond", 2014). Minima are aggregated before each shuffle and joined back, so no neighbour list is collected; each round is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.select("a", F.col("m").alias("b")).unionByName(moved.select(F.col("b").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()


def components(spark: SparkSession, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node with an edge; the root is the smallest node of its component."""
    now = stored(spark, edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        now = stored(spark, _small_star(_large_star(now)), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
            return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = seen
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
