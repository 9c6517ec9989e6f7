"""Connected components of a link table by alternating large-star and small-star steps (built-in functions only).

Each step is one aggregation (partial sums first) and one join on the node, so
a node with many links is split like any other skewed join. The edge table is
written after every round; links are never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import written

MAX_ROUNDS = 50


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = both.filter(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") != F.col("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (edges run from large to small)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link. ``links`` has columns a, b."""
    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                    "cc-links")
    for i in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges)), "cc-round")
        # done when no node has two links and no link ends in a node that has one
        open_ = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u").unionByName(
            edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi"))
        if open_.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError("components did not settle")
