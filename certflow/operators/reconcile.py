"""What two sets of names have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each distinct name with the side it is on: both, left_only or right_only.

    One aggregation over the tagged union does the work of a full outer join with
    a single exchange; copies of a name are merged map-side.
    """
    tagged = left.select(key, F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        right.select(key, F.lit(False).alias("l"), F.lit(True).alias("r"))
    )
    both = tagged.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    side = F.when(F.col("l") & F.col("r"), "both").when(F.col("l"), "left_only").otherwise("right_only")
    return both.select(key, side.alias("side"))


def side_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Number of names per side and the first and last of them as samples."""
    return sides(left, right, key).groupBy("side").agg(
        F.count("*").alias("names"), F.min(key).alias("first_name"), F.max(key).alias("last_name")
    )


def missing(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required names that are absent."""
    return required.select(key).subtract(present.select(key))


def shared(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Names on both sides."""
    return left.select(key).intersect(right.select(key))
