"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import drop_stored, stored


def _with_least(edges: DataFrame, node: str, how: str) -> DataFrame:
    """``edges`` (a, b; a is larger) with ``root``, the smallest neighbour of the node that column ``node`` names.

    The key is negated, so that the aggregated side is dealt anew by it: both sides of the join are then plain
    shuffles, and a node with very many edges is split as a skewed join.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.bitwise_not("a").alias("_key"), "root")
    return edges.withColumn("_key", F.bitwise_not(node)).join(least, "_key", how).drop("_key")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    return _with_least(edges, "b", "left").select("a", F.coalesce("root", "b").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smaller = _with_least(edges, "a", "inner").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return smaller.union(edges.groupBy("a").agg(F.min("b").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable from each node of ``edges`` (a, b).

    Each round is written to the shared folder, so lineage does not grow. It ends
    when every node has one link, to a node that has none: stars.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        repeated = now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not repeated and not now.select(F.col("b").alias("x")).join(now.select(F.col("a").alias("x")), "x", "left_semi").limit(1).count():
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        last, now = now, stored(_small_star(_large_star(now)), "edges")
        drop_stored(last)
