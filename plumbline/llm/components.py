"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps.

Each step gives every node's neighbours to the smallest of them; a few steps leave stars, whose centres are the smallest
nodes. All steps are aggregations and joins; nothing is gathered, and the number of steps grows with the logarithm of
the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.lineage import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with a < b; every node u hands neighbours (larger ones, or smaller ones with itself) to its least."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    handed = both.join(least, "u")
    if large:
        handed = handed.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        handed = handed.select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return handed.where("a < b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or the end of one edge."""
    once = edges.groupBy("b").agg(F.count("*").alias("n"), F.first("a").alias("a"))
    return once.where("n > 1").isEmpty() and once.select("a").join(once.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another node; component is the smallest node it reaches.

    edges has two integer columns a and b; their order, repeats and loops don't matter, and rows with a null are ignored.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("a").isNull().alias("x"), F.col("b").isNull().alias("y"))
    edges = written(edges.where("NOT x AND NOT y AND a < b").select("a", "b").distinct(), "edges")
    while not _are_stars(edges):
        edges = written(_star(_star(edges, large=True), large=False), "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
