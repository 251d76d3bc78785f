"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def _pointed(pairs: DataFrame) -> DataFrame:
    """``(u, v, low)``: each neighbour v of u with the smallest of u and its neighbours."""
    low = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    return pairs.join(low, "u")


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(src, dst)``; root is the smallest node reachable.

    Each round points the larger neighbours of a node, then the smaller ones, at the smallest; the
    number of rounds grows with the logarithm of the longest chain. Rounds are written to the
    shared folder, and a round that changes nothing ends the loop. Minima are taken before the
    shuffle, so a node with very many links costs one row per task there; the join that follows
    can be split by adaptive execution.
    """
    edges = stored(links.where("src != dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct()
        small = _pointed(large)
        edges = stored(
            small.select(F.col("v").alias("u"), F.col("low").alias("v")).union(small.select("u", F.col("low").alias("v"))).where("u != v").distinct(), "links"
        )
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
