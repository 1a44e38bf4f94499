"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.storage import stored


def _star(links: DataFrame) -> DataFrame:
    """Each node ``u`` of (u, v) with the least of itself and its neighbours, beside every ``v``."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    # A hub has as many edges as its component: stored, its one row joins by a shuffle that is split.
    return links.join(stored(least, "least_neighbours"), "u")


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked with the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _star(down)
    others = joined.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = joined.where("u > least").select("u", F.col("least").alias("v"))
    return others.unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (u, v).

    Each pass writes the edges to the shared folder; their number does not grow,
    and passes grow with the logarithm of the longest path.
    """
    edges = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    mark = None
    while True:
        edges = stored(_small(stored(_large(edges), "large_star")), "small_star")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    # Every edge now leads straight to the least node of its component.
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
