"""S1 to L5 as a stream of landed files: each new file is imported once, in batches that can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from certflow.plans.jobs import import_certificates
from certflow.sources.tables import append_batch

FILE = "path string, modificationTime timestamp, length long, content binary"


def batch_name(epoch: int) -> str:
    """Names sort in the order of the epochs."""
    return f"stream-{epoch:012}"


def import_epoch(files: DataFrame, epoch: int, root: str) -> None:
    """Import the files of one epoch; the same epoch again replaces its own rows only, and reads what its first run read.

    Their paths are few by the stream's limit on files per batch. The files are listed in the table `stream_files`.
    """
    spark = files.sparkSession
    found = files.select("path", "modificationTime", "length").collect()
    append_batch(spark.createDataFrame(found, "path string, modificationTime timestamp, length long"), root, "stream_files", batch_name(epoch))
    if found:
        report = import_certificates(spark, [r.path for r in found], root, batch_name(epoch))
        append_batch(report, root, "stream_reports", batch_name(epoch))


def import_available(spark: SparkSession, path: str, root: str, files_per_batch: int = 1000) -> int:
    """Import all files that have landed below `path` since the last call, and stop; gives the number of batches.

    Spark's file source keeps in its checkpoint, below `root`, which files it has handed out, and by `availableNow`
    ends when all that are there are done. A batch that was lost on its way is handed out again under its
    number. Contents are read by the import itself; the stream only carries the listing.
    """
    files = (spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch).load(path))
    query = (files.select("path", "modificationTime", "length").writeStream.foreachBatch(lambda df, epoch: import_epoch(df, epoch, root))
             .option("checkpointLocation", f"{root}/_stream").trigger(availableNow=True).start())
    query.awaitTermination()
    return len([p for p in query.recentProgress if p["numInputRows"]])
