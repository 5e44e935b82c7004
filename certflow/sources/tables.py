"""Stage tables as Parquet folders with a commit log, and S10, A13: what they hold.

A batch is written to its own folder, so a repeated run of the same batch replaces
its own output and nothing else. The table's log names the folders that count: a reader lists
the log, reads its newest file, and opens those folders. Small batches can be folded into one folder.
A table that changes is written as a whole to a version folder of the batch; names of batches sort in the order of their runs.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

LOG = "_log"
KEPT_LOGS = 10
BATCH = "_batch"  # the batch of a row in a fold


def _system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its class of paths."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Finished sub-folders `prefix...` of a table, by name."""
    fs, make = _system(spark, path)
    if not fs.exists(make(path)):
        return []
    found = [s.getPath() for s in fs.listStatus(make(path)) if s.getPath().getName().startswith(prefix)]
    done = [p for p in found if fs.exists(make(p, "_SUCCESS"))]
    return sorted(p.toString() for p in done)


def _log_files(spark: SparkSession, table: str) -> list[str]:
    fs, make = _system(spark, table)
    log = make(f"{table}/{LOG}")
    if not fs.exists(log):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(log) if s.getPath().getName().isdigit())


def read_log(spark: SparkSession, table: str) -> tuple[int, list[dict]]:
    """Number and entries of the newest state of a table; 0 and none without one.

    An entry has folder, batches (whose rows it holds) and without (batches in it that a later folder replaces).
    """
    names = _log_files(spark, table)
    if not names:
        return 0, []
    fs, make = _system(spark, table)
    stream = fs.open(make(f"{table}/{LOG}/{names[-1]}"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(names[-1]), json.loads(text)


def _commit(spark: SparkSession, table: str, number: int, entries: list[dict]) -> bool:
    """Write the next state of a table; false if another writer was first. Old states go, but for the last few."""
    fs, make = _system(spark, table)
    jvm = spark.sparkContext._jvm
    place = f"{table}/{LOG}/{number:020}"
    draft = make(f"{table}/{LOG}/.{jvm.java.util.UUID.randomUUID().toString()}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(entries).encode()))
    finally:
        out.close()
    # a whole file appears under its name or none does, and not over that of another writer
    if fs.exists(make(place)) or not fs.rename(draft, make(place)):
        fs.delete(draft, False)
        return False
    for name in _log_files(spark, table)[:-KEPT_LOGS]:
        fs.delete(make(f"{table}/{LOG}/{name}"), False)
    return True


def _change(spark: SparkSession, table: str, change) -> list[dict]:
    """Apply `change` to the newest entries and commit the result, anew if another writer came between."""
    while True:
        number, entries = read_log(spark, table)
        if number == 0:  # folders of a table from before it had a log
            entries = [{"folder": p.rsplit("/", 1)[1], "batches": [p.rsplit("/batch=", 1)[1]], "without": []} for p in _folders(spark, table, "batch=")]
        after = change(entries)
        if _commit(spark, table, number + 1, after):
            return after


def append_batch(df: DataFrame, root: str, table: str, batch: str) -> DataFrame:
    """Write one batch, give it back as read from storage."""
    spark, path = df.sparkSession, f"{root}/{table}/batch={batch}"
    df.write.mode("overwrite").parquet(path)

    def change(entries: list[dict]) -> list[dict]:
        own = {"folder": f"batch={batch}", "batches": [batch], "without": []}
        rest = [{**e, "without": sorted({*e["without"], batch})} if batch in e["batches"] else e for e in entries if e["folder"] != own["folder"]]
        return [*rest, own]

    _change(spark, f"{root}/{table}", change)
    return spark.read.schema(df.schema).parquet(path)


def _live(spark: SparkSession, table: str, schema: StructType, entries: list[dict], skip: str | None = None) -> DataFrame:
    """The rows that count, with their batch: one read of all batches and one of all folds."""
    plain = [f"{table}/{e['folder']}" for e in entries if e["folder"].startswith("batch=") and e["batches"] != [skip]]
    folds = [e for e in entries if e["folder"].startswith("fold=")]
    names, parts = [f.name for f in schema.fields], []
    if plain:
        batch = F.regexp_extract(F.col("_metadata.file_path"), "/batch=([^/]*)/[^/]*$", 1)
        parts.append(spark.read.schema(schema).parquet(*plain).select(*[F.col(f"`{n}`") for n in names], F.url_decode(batch).alias(BATCH)))
    if folds:
        folded = StructType([*schema.fields]).add(BATCH, StringType())
        rows = spark.read.schema(folded).parquet(*[f"{table}/{e['folder']}" for e in folds]).withColumn(
            "_fold", F.regexp_extract(F.col("_metadata.file_path"), "/(fold=[^/]*)/[^/]*$", 1))
        for e in folds:
            gone = sorted({*e["without"], *([skip] if skip in e["batches"] else [])})
            if gone:
                rows = rows.where((F.col("_fold") != e["folder"]) | ~F.col(BATCH).isin(gone))
        parts.append(rows.select(*[F.col(f"`{n}`") for n in names], BATCH))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], StructType([*schema.fields]).add(BATCH, StringType()))


def read_batches(
    spark: SparkSession, root: str, table: str, schema: StructType, skip: str | None = None
) -> DataFrame:
    """All committed batches of a table; empty when there is none yet.

    A run passes its own batch as `skip`, so a repeated run sees what the first one saw. One listing of the log tells the folders.
    """
    return _live(spark, f"{root}/{table}", schema, read_log(spark, f"{root}/{table}")[1], skip).drop(BATCH)


def fold_batches(spark: SparkSession, root: str, table: str, schema: StructType, least: int = 32) -> int:
    """Fold the batches that lie in folders of their own into one folder, if there are `least`; gives how many were folded.

    The rows keep their batch, so a batch can still be repeated or skipped. The folders stay for
    readers that have begun, until `drop_folded` is called.
    """
    path = f"{root}/{table}"
    number, entries = read_log(spark, path)
    plain = [e for e in entries if e["folder"].startswith("batch=")]
    if len(plain) < least:
        return 0
    fold = {"folder": f"fold={number + 1:020}", "batches": sorted(b for e in plain for b in e["batches"]), "without": []}
    # rows of a batch that is written anew while they are folded are given up: its new folder is in the log then
    _live(spark, path, schema, plain).write.mode("overwrite").parquet(f"{path}/{fold['folder']}")
    folders = {e["folder"] for e in plain}
    _change(spark, path, lambda now: [fold, *(e for e in now if e["folder"] not in folders)])
    return len(plain)


def drop_folded(spark: SparkSession, root: str, table: str) -> int:
    """Delete the folders that the log no longer names; call it when no reader uses an older state. Gives their number."""
    path = f"{root}/{table}"
    fs, make = _system(spark, path)
    known = {e["folder"] for e in read_log(spark, path)[1]}
    gone = [s.getPath() for s in fs.listStatus(make(path)) if s.getPath().getName().split("=")[0] in ("batch", "fold") and s.getPath().getName() not in known]
    for place in gone:
        fs.delete(place, True)
    return len(gone)


def write_version(df: DataFrame, root: str, table: str, batch: str) -> DataFrame:
    """Write the whole table as the version of a batch; the one being read stays untouched."""
    path = f"{root}/{table}/version={batch}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_version(
    spark: SparkSession, root: str, table: str, schema: StructType, before: str | None = None
) -> DataFrame:
    """The newest version by name of batch, or the newest before a batch; empty when there is none.

    A run passes its own batch as `before`, so a repeated run reads what the first one read.
    """
    paths = _folders(spark, f"{root}/{table}", "version=")
    paths = [p for p in paths if before is None or p.rsplit("/version=", 1)[1] < before]
    return spark.read.schema(schema).parquet(paths[-1]) if paths else spark.createDataFrame([], schema)


def pinned_version(spark: SparkSession, root: str, table: str, schema: StructType, user: str, batch: str) -> DataFrame:
    """The version of a table that a batch of another table read first: the newest at its first run, the same one when it is repeated."""
    path = f"{root}/{table}"
    own = f"{root}/{user}_inputs/batch={batch}"
    fs, make = _system(spark, own)
    if fs.exists(make(f"{own}/_SUCCESS")):
        used = spark.read.parquet(own).first()[0]
    else:
        found = _folders(spark, path, "version=")
        used = found[-1].rsplit("/", 1)[1] if found else None
        spark.createDataFrame([(used,)], f"{table} string").write.mode("overwrite").parquet(own)
    return spark.read.schema(schema).parquet(f"{path}/{used}") if used else spark.createDataFrame([], schema)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table. A count over Parquet reads no column data."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def data_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column with type, place and nullability, and the table's row count."""
    spark = next(iter(tables.values())).sparkSession
    columns = [
        (name, field.name, i + 1, field.dataType.simpleString(), field.nullable)
        for name, df in tables.items()
        for i, field in enumerate(df.schema.fields)
    ]
    described = spark.createDataFrame(
        columns, "table_name string, column_name string, position int, data_type string, nullable boolean"
    )
    return described.join(row_counts(tables), "table_name")


def dictionary_markdown(dictionary: DataFrame) -> DataFrame:
    """The dictionary as Markdown lines, one table per heading, ready for `write.text`."""
    mark = F.when(F.col("nullable"), "yes").otherwise("no")
    cells = F.concat_ws(" | ", F.lit("").alias("x"), "column_name", "data_type", mark)
    heads = dictionary.select("table_name", "row_count").distinct().select(
        "table_name", F.lit(0).alias("position"),
        F.concat(F.lit("\n## "), "table_name", F.lit("\n\nRows: "), F.col("row_count").cast("string"),
                 F.lit("\n\n | Column | Type | Nullable |\n | --- | --- | --- |")).alias("value"),
    )
    lines = dictionary.select("table_name", "position", F.concat(cells, F.lit(" |")).alias("value"))
    return heads.unionByName(lines).orderBy("table_name", "position").select("value")


def object_counts(spark: SparkSession) -> DataFrame:
    """Tables and columns per database of the session's catalog; views of the session count as 'temporary'."""
    rows = [
        (db.name, t.name, len(spark.catalog.listColumns(f"`{db.name}`.`{t.name}`")))
        for db in spark.catalog.listDatabases()
        for t in spark.catalog.listTables(db.name)
        if not t.isTemporary
    ]
    views = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    rows += [("temporary", name, len(spark.catalog.listColumns(f"`{name}`"))) for name in views]
    found = spark.createDataFrame(rows, "schema_name string, table_name string, n int")
    return found.groupBy("schema_name").agg(F.count("*").alias("tables"), F.sum("n").alias("columns"))
