"""Connected components of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pledgemart.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node of its component.

    Large step: every larger neighbour of a node is hung on the smallest of the node and its
    neighbours. Small step: so are the smaller neighbours, with the node itself. Both keep the
    components, and in turn they end in stars around the roots, after a number of rounds that grows
    with the logarithm of the size. A node's neighbours are never gathered: the smallest one comes
    from an aggregate and is joined back, and links are only read as rows. Each round is staged.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = stage(edges)
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state.n == 0 or state == before:
            break
        before = state
        edges = stage(_small(_large(edges)))
    roots = edges.select(F.col("a").alias("root"), F.col("b").alias("node"))
    return roots.union(roots.select("root", F.col("root").alias("node")).distinct()).select("node", "root")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    hung = edges.join(least, "b").select("m", "a", "b")
    out = hung.select(F.col("m").alias("a"), F.col("a").alias("b")).union(hung.select(F.col("m").alias("a"), "b"))
    return out.filter("a < b").distinct()
