"""Percentiles from counts per logarithmic bucket, which are stored by batch and added up."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

ERROR = 0.01


def _base(error: float) -> float:
    return (1 + error) / (1 - error)


def bucket_of(value: Column, error: float = ERROR) -> Column:
    """The bucket of a number: all numbers of a bucket lie within `error` of its middle, relative to it; 0 has one of its own.

    Positive numbers have odd buckets from their logarithm, negative ones even buckets mirrored,
    so the order of `bucket_rank` is that of the numbers.
    """
    place = F.ceil(F.ln(F.abs(value)) / math.log(_base(error)))
    return F.when(value == 0, F.struct(F.lit(0).alias("sign"), F.lit(0).cast("long").alias("place"))).when(
        value.isNotNull() & ~F.isnan(value), F.struct(F.signum(value).cast("int").alias("sign"), place.cast("long").alias("place")))


def sketch(rows: DataFrame, by: list[str], value: str | Column, error: float = ERROR) -> DataFrame:
    """Counts per bucket: `by`, sign, place, n. Merged map-side; a group has some thousand buckets at most. Null and NaN count nowhere."""
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    return rows.select(*by, bucket_of(value, error).alias("b")).where("b IS NOT NULL").groupBy(*by, "b.sign", "b.place").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of batches or groups added up to coarser groups; equal to the sketch of all their rows."""
    return sketches.groupBy(*by, "sign", "place").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: list[str], shares: list[float], error: float = ERROR) -> DataFrame:
    """`by`, share, estimate: the smallest number that at least that share of the numbers does not exceed, within `error` of it.

    The windows run over buckets, never over rows.
    """
    order = F.col("sign") * F.col("place")
    window = Window.partitionBy(*by).orderBy("sign", order)
    whole = Window.partitionBy(*by)
    base = _base(error)
    middle = F.col("sign") * 2 * F.pow(F.lit(base), F.col("place")) / (base + 1)
    counted = merged(sketches, by).withColumns({"upto": F.sum("n").over(window), "all": F.sum("n").over(whole), "estimate": middle})
    wanted = F.explode(F.array(*[F.lit(s) for s in shares]))
    reached = counted.withColumn("share", wanted).where(F.col("upto") >= F.ceil(F.col("share") * F.col("all")))
    return reached.groupBy(*by, "share").agg(F.min_by("estimate", "upto").alias("estimate"))
