"""Connected components by alternating large and small stars, in Spark only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rategauge.plans.scratch import stored


def _hooked(edges: DataFrame) -> DataFrame:
    """Large star: every neighbour above a node is tied to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u").where("v > u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _lowered(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``links(a, b)``; the component is its smallest id.

    A few rounds, each one a stored table: the number grows with the logarithm of the longest
    chain. Minima are taken per task before the shuffle, and the joins have one row per node on one
    side, so a node with very many links is split by AQE. Only a count and a checksum reach the
    driver. No link, no row; nulls and self-links are left out.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges, seen = stored(edges.distinct(), "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == seen:
            break
        seen = now
        if now[0] == 0:
            break
        edges = stored(_lowered(_hooked(edges)), "edges")
    own = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(own)
