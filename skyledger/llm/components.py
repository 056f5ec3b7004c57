"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = store(both.groupBy("u").agg(F.min("v").alias("m"))
                  .select("u", F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(least, "u") \
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them.  After a
    large star these are minima only, so no node has many."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m") \
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """Label (``node``, ``root``) of every node of ``links`` (a, b) that is not
    the smallest of its component; the root is the smallest.

    Self links, repeated links and nulls are let go; no links give no rows.  A
    node's neighbours are never gathered: each round takes minima with map-side
    aggregates.  Those of the large star are stored and joined back between plain
    shuffles, so the skew join splits the links of a node with very many.  The number of
    rounds follows the logarithm of the nodes.
    """
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("a <> b").distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = _state(edges)
    while True:
        edges = store(_small_star(_large_star(edges)), "stars")
        found = _state(edges)
        if found == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = found
