"""Joins of a large row side, which may hold very hot keys, with a unique side.

AQE splits a skewed side only when both sides come straight from an exchange, and a
de-duplicated key set does not. So rows of heavy keys are salted here: by their whole
content, which gives the same salt again when a lost task is repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HEAVY_ROWS = 1_000_000


def salted_join(
    rows: DataFrame, unique: DataFrame, keys: list[str], how: str, heavy_rows: int | None = HEAVY_ROWS
) -> DataFrame:
    """Join rows with a frame that is unique by `keys`.

    Keys are counted first, merged map-side; one of more than `heavy_rows` rows falls into parts
    of about that many, and its row of the unique side is repeated as often. No other row is.
    There is at most one heavy key for each `heavy_rows` rows, so their list is small enough
    to send out. None leaves the count out, for keys that are unique on both sides.
    Rows with a null key match nothing and are spread by content.
    """
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    content = F.xxhash64(*rows.columns)
    spread_nulls = F.when(any_null, F.pmod(content, F.lit(2**31 - 1)))
    if heavy_rows is None:
        left = rows.withColumn("_salt", F.coalesce(spread_nulls, F.lit(0)).cast("long"))
        right = unique.withColumn("_salt", F.lit(0).cast("long"))
        return left.join(right, [*keys, "_salt"], how).drop("_salt")
    heavy = (rows.where(~any_null).groupBy(*keys).agg(F.ceil(F.count("*") / heavy_rows).alias("_parts"))
             .where("_parts > 1"))
    parts = F.coalesce("_parts", F.lit(1))
    left = (rows.join(F.broadcast(heavy), keys, "left")
            .withColumn("_salt", F.coalesce(spread_nulls, F.pmod(content, parts)).cast("long")).drop("_parts"))
    right = (unique.join(F.broadcast(heavy), keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
