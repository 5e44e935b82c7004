"""Changes of stored rows as functions from old rows to new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from certflow.operators.conform import keep_first
from certflow.operators.skew import salted_join
from certflow.operators.worklists import not_done
from certflow.schemas import API_LOG

PENDING = "Pending"


def log_pending(worklist: DataFrame, batch_time: Column) -> DataFrame:
    """L1: one pending log row per worklist row."""
    rows = worklist.withColumns({
        "LogDate": batch_time,
        "records_returned": F.lit(None).cast("long"),
        "status_message": F.lit(PENDING),
        "Created": batch_time,
    })
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in API_LOG.fields])


def resolve_pending(log: DataFrame, outcomes: DataFrame, order: list[str] | None = None) -> DataFrame:
    """L2: give every pending row of a called certificate its outcome; other rows stay.

    With several outcomes for one certificate the first by `order` counts, as later
    ones find nothing pending.
    """
    first = keep_first(outcomes, ["CertificateID"], order or ["status_message", "records_returned"])
    first = first.select(
        "CertificateID", F.col("records_returned").alias("_records"), F.col("status_message").alias("_status")
    )
    hit = (F.col("status_message") == PENDING) & F.col("_status").isNotNull()
    return salted_join(log, first, ["CertificateID"], "left").select(
        *[
            F.when(hit, F.col(new)).otherwise(F.col(c)).alias(c) if new else F.col(c)
            for c, new in ((c, {"records_returned": "_records", "status_message": "_status"}.get(c)) for c in log.columns)
        ]
    )


def stale(as_of: Column, hours: int) -> Column:
    return (F.col("status_message") == PENDING) & (F.col("LogDate") < as_of - F.make_interval(hours=F.lit(hours)))


def expire_pending(log: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """L3: drop pending rows older than `hours` (strictly)."""
    return log.filter(~F.coalesce(stale(as_of, hours), F.lit(False)))


def purge_gone(inventory: DataFrame, listing: DataFrame) -> DataFrame:
    """L4: inventory rows whose path is still listed."""
    return inventory.join(listing.select("full_path").distinct(), "full_path", "left_semi").select(*inventory.columns)


def append_new(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The incoming rows to add, and the counts of added and skipped ones.

    Only the keys are used for the counts, with copies merged map-side.
    """
    added = not_done(incoming, stored, keys, "keys")
    copies = incoming.groupBy(*keys).agg(F.count("*").alias("copies"))
    marked = copies.join(stored.select(*keys).distinct().withColumn("_stored", F.lit(True)), keys, "left")
    counts = marked.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum(F.when(F.col("_stored").isNull(), F.col("copies"))), F.lit(0)).alias("added"),
        F.coalesce(F.sum(F.when(F.col("_stored").isNotNull(), F.col("copies"))), F.lit(0)).alias("skipped"),
    )
    return added, counts


def merge(stored: DataFrame, incoming: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """Incoming rows replace stored rows of the same key; the newest incoming row wins.

    The stored side only meets the incoming keys in an anti join, so a small batch
    is broadcast by Spark when its measured size allows and the large table stays put.
    """
    latest = keep_first(incoming, keys, newest_first)
    return not_done(stored, incoming, keys).unionByName(latest)


def archive(answers: DataFrame, before: Column) -> tuple[DataFrame, DataFrame]:
    """Answers created before a time, and the rest."""
    old = F.coalesce(F.col("Created") < before, F.lit(False))
    return answers.filter(old), answers.filter(~old)
