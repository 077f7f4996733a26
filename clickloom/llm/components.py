"""Connected components by alternating large and small stars; nothing leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("m"))
    return (near.where("b > a").join(least, "a").where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them. ``a`` is above ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    """Tells two sets of edges apart: their number and the sum of their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(node, component)``, the least node reachable, for every node of ``edges(a, b)``.

    ``known`` is an earlier result for other edges of the same graph. Each round moves every edge
    once; the number of rounds grows with the logarithm of the number of nodes. Nodes tied to very
    many others are met only by aggregates and joins on single rows of the least neighbour, which
    Spark can split.
    """
    if known is not None:
        edges = edges.union(known.select(F.col("node").alias("a"), F.col("component").alias("b")))
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    seen, before = None, None
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        if before is not None:
            discard(before)
        before, now = edges, _print(edges)
        if now == seen:
            break
        seen = now
    # stars remain: every node but a centre has one edge to its centre
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = written(stars.union(centres), "components")
    discard(edges)
    return out
