"""Recursive file listing, by Spark's reader or folder by folder in tasks, and what changed since the last one."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from certflow.sources.tables import read_version, write_version

_ENTRY = "full_path string, is_folder boolean, file_size long, modified timestamp"
_ENTRY_TYPES = pa.schema([("full_path", pa.string()), ("is_folder", pa.bool_()), ("file_size", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])


def list_files(spark: SparkSession, path: str, glob: str | None = "*.[pP][dD][fF]") -> DataFrame:
    """Name, path, size, lower-cased suffix and time of each file below `path`.

    The file content is never read: only metadata columns of the source are used.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", True)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path)
    return found.select(*_listed(F.col("path"), F.col("length"), F.col("modificationTime")))


def _listed(path: Column, size: Column, modified: Column) -> list[Column]:
    name = F.element_at(F.split(path, "/"), -1)
    return [name.alias("filename"), path.alias("full_path"), size.alias("file_size"),
            F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)\z", 1)).alias("file_extension"), modified.alias("modified")]


def entries(folder: str) -> list[tuple[str, bool, int | None, int]]:
    """What lies in a folder: path, whether it is a folder, size, and time in milliseconds.

    Names that Spark's own readers take as hidden are left out; a folder that has gone meanwhile is empty.
    """
    # pyarrow's name of the object store; a local folder may have a scheme or none
    system, place = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    prefix = "file:" if isinstance(system, fs.LocalFileSystem) else folder[:len(folder) - len(place)]
    out = []
    for x in system.get_file_info(fs.FileSelector(place, allow_not_found=True)):
        hidden = x.base_name.startswith("_") and "=" not in x.base_name or x.base_name.startswith(".") or x.base_name.endswith("._COPYING_")
        if not hidden and x.type in (fs.FileType.File, fs.FileType.Directory):
            out.append((prefix + x.path, x.type == fs.FileType.Directory, x.size, int(x.mtime_ns // 1_000_000)))
    return out


def list_tree(spark: SparkSession, folders: list[str], staging: str, glob: str | None = "*.[pP][dD][fF]", folders_per_task: int = 100) -> DataFrame:
    """The rows of `list_files`, listed folder by folder in tasks and level by level.

    Each level is stored below `staging` and gives the folders of the next, so the driver holds the given folders
    and a count for each level, never paths. A folder is listed by one task and lies in its memory. The file system must be one that pyarrow knows.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = entries(folder)
                for k in range(0, len(found), 10_000):
                    path, is_folder, size, time = zip(*found[k:k + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(path), pa.array(is_folder), pa.array(size, pa.int64()), pa.array([t * 1000 for t in time], pa.timestamp("us", "UTC"))],
                        schema=_ENTRY_TYPES)

    level, n, files = spark.createDataFrame([(f.rstrip("/"),) for f in folders], "full_path string"), len(folders), []
    while n:
        place = f"{staging}/level={len(files)}"
        tasks = -(-n // folders_per_task)
        level.select("full_path").repartition(tasks, "full_path").mapInArrow(listed, _ENTRY).write.mode("overwrite").parquet(place)
        files.append(place)
        found = spark.read.schema(_ENTRY).parquet(place)
        level = found.where("is_folder")
        n = level.count()
    rows = spark.read.schema(_ENTRY).parquet(*files) if files else spark.createDataFrame([], _ENTRY)
    rows = rows.where(~F.col("is_folder")).select(*_listed(F.col("full_path"), F.col("file_size"), F.col("modified")))
    return rows.where(F.col("filename").rlike(fnmatch.translate(glob).replace("(?s:", "(?s)(?:"))) if glob else rows


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files of two listings that differ: full_path, change (added, removed, changed) and both sizes.

    One aggregation of a tagged union; a file is changed if its size or time is.
    """
    side = lambda df, name: df.select(
        "full_path", *[F.when(F.lit(name == tag), F.struct("file_size", "modified")).alias(tag) for tag in ("old", "new")])
    both = side(before, "old").unionByName(side(after, "new")).groupBy("full_path").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return both.withColumn("change", change).where("change IS NOT NULL").select(
        "full_path", "change", F.col("old.file_size").alias("old_size"), F.col("new.file_size").alias("new_size"))


def scan_manifest(spark: SparkSession, folders: list[str], root: str, batch: str, glob: str | None = "*.[pP][dD][fF]") -> DataFrame:
    """List the folders into the table `manifest`, and give what changed since the version before the batch."""
    listing = list_tree(spark, folders, f"{root}/manifest_levels/batch={batch}", glob)
    before = read_version(spark, root, "manifest", listing.schema, batch)
    return changed_files(before, write_version(listing, root, "manifest", batch))
