"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.session import keep


def _towards_larger(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a node moves to its least neighbour."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    moved = both.filter("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _towards_smaller(edges: DataFrame) -> DataFrame:
    """Small star: the smaller neighbours of a node (and it) move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns node, root: the least node each linked node other than it can reach.

    ``edges`` has two comparable non-NULL columns a and b. Alternating large and
    small stars leaves one edge per node; every round is written to the shared
    folder. A node with very many neighbours is only ever aggregated or joined,
    never collected.
    """
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    state, mark = keep(turned, "edges"), None
    while True:
        found = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if found == mark or not found[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = found
        state = keep(_towards_smaller(_towards_larger(state)), "stars")
