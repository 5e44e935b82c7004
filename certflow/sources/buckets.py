"""Stage tables in buckets of their keys, of which a change rewrites only those that it touches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from certflow.operators.conform import keep_first
from certflow.sources.tables import _folders, append_batch

BUCKET = "_bucket"


def bucket_of(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias(BUCKET)


def _place(spark: SparkSession, root: str, table: str) -> tuple[str, int] | None:
    """Folder of a bucketed table and its number of buckets, which the folder's name tells."""
    found = _folders(spark, f"{root}/{table}", "buckets=")
    return (found[-1], int(found[-1].rsplit("=", 1)[1])) if found else None


def write_buckets(df: DataFrame, root: str, table: str, keys: list[str], n: int) -> DataFrame:
    """Write a whole table in `n` buckets; choose `n` so that a bucket is some hundred megabytes. Null keys make up a bucket like others."""
    path = f"{root}/{table}/buckets={n}"
    _written(df.withColumn(BUCKET, bucket_of(keys, n)), path, "static")
    return read_buckets(df.sparkSession, root, table, df.schema)


def _written(rows: DataFrame, path: str, mode: str) -> None:
    # one file for a bucket, more where Spark finds it large
    (rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(path))


def read_buckets(spark: SparkSession, root: str, table: str, schema: StructType, touched: list[int] | None = None) -> DataFrame:
    """The rows of a bucketed table, or of some buckets, whose files alone are then read."""
    place = _place(spark, root, table)
    if place is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields]).add(BUCKET, IntegerType())).parquet(place[0])
    if touched is not None:
        rows = rows.where(F.col(BUCKET).isin(touched))
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def merge_buckets(
    incoming: DataFrame, root: str, table: str, schema: StructType, keys: list[str], newest_first: list[Column], batch: str,
) -> DataFrame:
    """J12 in place: incoming rows replace stored rows of the same key (null is one), the newest incoming row wins.

    Gives the row counts of the touched buckets.

    The batch's rows and the new content of the touched buckets are staged first, so a run that
    is lost on its way is repeated from the same rows and ends in the same table: a merge of the same batch changes nothing
    more. Buckets without incoming rows are neither read nor written. Batches run in the order
    of their names; an older one than the last is refused, as its rows would replace newer ones.
    Only the numbers of touched buckets reach the driver.
    """
    spark = incoming.sparkSession
    place = _place(spark, root, table)
    if place is None:
        raise ValueError(f"no bucketed table {table} below {root}")
    path, n = place
    done = _folders(spark, f"{root}/{table}_merged", "batch=")
    if done and batch < done[-1].rsplit("/batch=", 1)[1]:
        raise ValueError(f"batch {batch} is older than the last merged one")
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    latest = keep_first(incoming, keys, newest_first).select(*columns).withColumn(BUCKET, bucket_of(keys, n))
    latest = append_batch(latest, root, f"{table}_incoming", batch)
    touched = sorted(r[0] for r in latest.select(BUCKET).distinct().collect())
    stored = read_buckets(spark, root, table, schema, touched).withColumn(BUCKET, bucket_of(keys, n))
    merged = append_batch(_without(stored, latest, keys).unionByName(latest), root, f"{table}_merged", batch)
    if touched:
        _written(merged, path, "dynamic")
    return merged.groupBy(F.col(BUCKET).alias("bucket")).agg(F.count("*").alias("rows"))


def purge_buckets(spark: SparkSession, root: str, table: str, schema: StructType, keys: list[str], gone: DataFrame) -> int:
    """L4 in place: rows whose key is among `gone` leave the table; gives how many buckets were written anew."""
    place = _place(spark, root, table)
    if place is None:
        return 0
    path, n = place
    gone = gone.select(*keys).distinct()
    touched = sorted(r[0] for r in gone.select(bucket_of(keys, n)).distinct().collect())
    if not touched:
        return 0
    stored = read_buckets(spark, root, table, schema, touched)
    kept = _without(stored, gone, keys).withColumn(BUCKET, bucket_of(keys, n))
    staged = append_batch(kept, root, f"{table}_purged", "last")
    left = {r[0] for r in staged.select(BUCKET).distinct().collect()}
    if left:
        _written(staged, path, "dynamic")
    # a bucket that lost all its rows has nothing to be overwritten with
    jvm = spark.sparkContext._jvm
    for bucket in touched:
        if bucket not in left:
            empty = jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}={bucket}")
            empty.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(empty, True)
    return len(touched)


def _without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among those of `gone`; here a null is a key like any other."""
    gone = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys]).distinct()
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys])
    return rows.join(gone, same, "left_anti")
