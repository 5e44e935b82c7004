"""Even work for the text stages and for joins of large tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

SETTING = "spark.certflow.text.partitions"
ROWS_PER_TASK = 1_000_000


def spread(rows: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash rows over `partitions` tasks, or over those that the session sets in SETTING; else leave them to their splits.

    For inputs of few row groups, whose heavy work would run in few tasks. Nothing is
    guessed: without a number from the caller or the session there is no exchange.
    """
    n = partitions or int(rows.sparkSession.conf.get(SETTING, "0"))
    return rows.repartition(n, key) if n else rows


def tasks_for(*tables: DataFrame) -> int:
    """Number of tasks in which one gets about ROWS_PER_TASK rows of all `tables`; at least one for each core.

    Columns of keys and dates shrink so far that their size in an exchange tells little about their rows in
    memory, and a fixed number of partitions gives each task more of a larger table. Stored tables are counted
    without a read of their columns.
    """
    rows = sum(t.count() for t in tables)
    return max(tables[0].sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
