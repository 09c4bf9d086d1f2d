"""Connected components of a graph of links, as rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least node next to it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # written, so that Spark can split the neighbours of one node when they are joined with it
    least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.filter("v > u").join(least.hint("merge"), "u").filter("v != m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    least = materialise(edges.groupBy("b").agg(F.min("a").alias("m")), "least")
    moved = edges.join(least.hint("merge"), "b").filter("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Returns node, component (the least node reachable) for each node that has a link.

    Alternates large and small stars; every round is written to the shared folder. Null ends, loops and
    repeated links are ignored; no links give no rows. A round moves as many rows as there are links at most.
    """
    edges = edges.filter("a is not null and b is not null and a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, before = materialise(edges, "links"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before, last = now, edges
        edges = materialise(_small_star(_large_star(edges)), "links")
        discard(last)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
