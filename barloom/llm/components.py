"""Connected components of a link table by alternating star contractions, all as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(low, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(low.select(F.col("m").alias("a"), "b")).where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of links(a, b), where root is the smallest node reachable.

    Self links and repeated links change nothing; an empty table gives an empty one. The number of rounds
    grows with the logarithm of the longest path; the driver sees two aggregates a round.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = materialize(edges, "links")
    before = _state(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
