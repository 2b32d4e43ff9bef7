"""Connected components of an edge table, by alternating stars: no task or driver holds a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.shared import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them (``b < a`` in every edge)."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    tied = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return tied.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the root is the least node it reaches.

    Every round is stored in the shared folder.  Loops and repeated edges are allowed; nodes without
    an edge to another node do not come.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:                       # the logarithm of a component's size squared, at most
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
