"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to its least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    up = both.where("v > u").join(least, F.col("u") == F.col("node"))
    return up.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them; u > v in every row."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least.withColumnRenamed("u", "node"), F.col("u") == F.col("node"))
    moved = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v); the root is the least node reachable.

    No node's links are ever gathered: a step is a minimum by node and a join, and both work for a
    node with any number of links. The links are written after each round, of which there are about as many as
    the logarithm of the longest chain.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut_lineage(edges.distinct())
    before = _state(edges)
    while before[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
