"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.session import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``(a, b)``; ``root`` is the smallest node reached.

    Nodes are only ever met by key: the smallest neighbour is an aggregate, and the edges join it.
    No node's neighbours are gathered, so a hub is split like any other skewed join. Each round is
    written to the shared folder; the driver gets a count and a checksum. Loops and repeated links
    change nothing; without links the result is empty.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = materialise(edges, "component-edges")
    state = _state(edges)
    while True:
        edges = materialise(_small_star(_large_star(edges)), "component-edges")
        last, state = state, _state(edges)
        if state == last:
            break
    tied = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return tied.unionByName(roots)
