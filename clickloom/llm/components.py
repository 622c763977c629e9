"""Connected components by alternating large and small stars.

Each round joins every node to the smallest of its neighbours. Rows are pairs, never lists, so a hub is an ordinary
hot key: minima combine before the shuffle, and the join is split by adaptive execution. Rounds grow with the
logarithm of the longest chain. Each round is written, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import write_and_read


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge (a, b); the component is its smallest node."""
    pairs = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    while True:
        small = _small_star(_large_star(pairs)).filter(F.col("a") != F.col("b")).distinct()
        pairs = write_and_read(small, "components")
        if _all_stars(pairs):
            break
    centres = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def _all_stars(pairs: DataFrame) -> bool:
    """Whether every node is either a centre or joined to exactly one centre."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        pairs.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    return ends.filter("out > 1 OR (out > 0 AND into > 0)").isEmpty()
