"""Connected components of a table of links, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.sources.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), where root is the smallest node that can be reached.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the node's smallest neighbour, then
    every smaller one is. The number of rounds grows with the logarithm of the longest path; each round is written to the shared folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(larger.filter("a <> b").distinct(), "links")
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(smaller.filter("a <> b").union(least).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
