"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.session import discard, written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reached) of all nodes in ``links`` (a, b); nodes without a link are absent.

    Each round links the neighbours of a node to the smallest of them; rounds grow with
    the logarithm of a component's width.  A node with very many links is aggregated
    before the shuffle and its links are spread by the join, which adaptive execution
    splits.  Every round is a written table; the driver only learns whether one more is due.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = written(edges, "links")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Dealt out by another key, so that the join does so anew and a node with many links can be split.
        lowest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).repartition(F.xxhash64("u"))
        large = (both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smallest, "u")
        small = (joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(smallest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        settled, edges = edges, written(small, "links")
        discard(settled)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node leads to one root at most and no root leads further."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("_up"), F.lit(0).alias("_down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    ways = ends.groupBy("node").agg(F.sum("_up").alias("_up"), F.max("_down").alias("_down"))
    return ways.filter("_up > 1 or (_up > 0 and _down > 0)").isEmpty()
