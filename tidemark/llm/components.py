"""Connected components by alternating large and small stars.

Each round points every node's larger neighbours, then its smaller ones, to the least node known
there, until all edges form stars; this takes few rounds even on long chains. A node's minimum is merged
map-side before it is shuffled and the joins are plain equi-joins, so a node with very many links is
split by adaptive execution. Every round is written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges are (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any one ordered type to ``(node, component)``, component being the least
    node reached. Nodes without an edge are left out; loops and nulls are ignored; repeated edges
    change nothing; no edges give an empty result."""
    tidy = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    tidy = staged(tidy, "links")
    while not _stars(tidy):
        tidy = staged(_small_star(_large_star(tidy)).distinct(), "links")
    roots = tidy.select(F.col("b").alias("node")).distinct()
    return tidy.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one lesser neighbour that has none itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.filter("up > 1 or (up = 1 and down = 1)").isEmpty()
