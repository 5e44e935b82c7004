"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certflow.llm.tasks import stored


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """The smallest node that each node of `edges` reaches: columns node, component.

    A large star ties the larger neighbours of a node to its smallest one, a small star the
    smaller ones; the edge count never grows and the rounds grow with the logarithm of the
    longest path. Each round is written to the shared folder. Minima are merged before the
    shuffle, stored, and joined back with an ordinary join: both its sides come straight from an
    exchange, so Spark can split the edges of a hot node.
    Edges with a null end and loops are left out; a node of only such edges is not returned.
    """
    u, v = F.col("u"), F.col("v")
    pairs = (edges.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
             .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")))
    stars = stored(pairs.distinct(), "edges")
    before = _mark(stars)
    while True:
        both = stars.select("u", "v").union(stars.select(v.alias("u"), u.alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
        large = stored(both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).distinct(),
                       "large-star")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        small = large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        stars = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _mark(stars)
        if after == before:
            break
        before = after
    return stars.select(u.alias("node"), v.alias("component")).union(
        stars.select(v.alias("node"), v.alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), checksum).first())
