"""Landed yearly CSV files, from probing to one DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from certflow.schemas import CERTIFICATE_COLUMNS
from certflow.session import scratch_dir
from certflow.sources.blocks import HEAD_LINES, SEPARATORS, chunks_of, records_of

# Name of a yearly file.
YEAR_PATTERN = r"enova_data_(\d{4})"
POSITION = ["source_path", "source_block", "source_row"]


def file_year(path: Column) -> Column:
    """Year in the file name, or in the folder that holds the parts of a large file."""
    return F.when(path.rlike(YEAR_PATTERN), F.regexp_extract(path, YEAR_PATTERN, 1).cast("int"))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    return raw.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _field_counts(lines: Column, separator: str) -> Column:
    """Number of fields of each line, separators inside quotes not counted."""
    return F.transform(lines, lambda x: F.size(F.split(F.regexp_replace(x, '"[^"]*"', ""), separator)))


def probe(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file with its dialect.

    UTF-8 is taken when every byte of the file is valid, else Latin-1; the other
    two encodings of the source system can never win, as they come later in a tie.
    The separator that gives strictly the most header columns wins, the first on a
    tie; one is out when a sample row has more fields than the header and the first
    row have. A file with a field that opens with a quote and isn't closed on its line is read
    in multi-line mode; a quote inside a plain field is a character like any other.

    Two scans: one of fixed-size sums, and one that keeps six lines per file, cut
    down inside each task before the exchange.
    """
    lines = _lines(spark, path)
    # what is left of a line without its closed quoted fields opens one if a field starts with a quote
    rest = F.regexp_replace("value", '(^|[,;\t])"[^"]*+(?:""[^"]*+)*+"(?=[,;\t]|$)', "$1")
    sums = lines.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(rest.rlike('(?:^|[,;\t])"')).alias("multi_line"),
        F.count(F.when(F.length(F.trim("value")) > 0, 1)).alias("physical_lines"),
    )
    order = Window.partitionBy("path").orderBy("block", "row")
    head = (
        lines.filter((F.col("block") == 0) & (F.length(F.trim("value")) > 0))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= HEAD_LINES)
        .groupBy("path")
        .agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("head"))
        .select("path", F.transform("head", lambda x: x["value"]).alias("head"))
    )
    rows = sums.join(head, "path").withColumn("first_line", F.col("head")[0])
    return _dialects(rows, F.coalesce("multi_line", F.lit(False)), lambda k: _field_counts(F.col("head"), SEPARATORS[k]))


def dialects_of(chunks: DataFrame) -> DataFrame:
    """The rows of `probe` from chunks, which hold what it needs: no further scan of the files.

    Its sample rows are whole records, so line ends in quoted fields do not mislead it.
    """
    over = [F.bool_or(F.col("over_lines")[k]).alias(f"over{k}") for k in range(len(SEPARATORS))]
    rows = chunks.groupBy("path").agg(
        F.bool_and("utf8").alias("utf8"), F.sum("physical_lines").alias("physical_lines"),
        F.max(F.col("header").cast("string")).alias("first_line"), F.max("fields").alias("fields"), *over,
    ).where("first_line IS NOT NULL")
    found = F.lit(False)
    for k, sep in enumerate(SEPARATORS):
        found = F.when(F.col("separator") == sep, F.col(f"over{k}")).otherwise(found)
    return _dialects(rows, found, lambda k: F.col("fields")[k])


def _dialects(rows: DataFrame, multi_line: Column, counts_of: Callable[[int], Column]) -> DataFrame:
    """Dialects from the first line of each file and the numbers of fields at each separator; `multi_line` may use the separator that is found."""
    header = F.regexp_replace(F.decode(F.col("first_line").cast("binary"), "ISO-8859-1"), "\\A\u00ef\u00bb\u00bf", "")
    header = F.when(F.col("utf8"), F.regexp_replace("first_line", "\\A\ufeff", "")).otherwise(header)
    rows = rows.withColumn("header", header)
    best = None
    for sep in SEPARATORS:
        counts = counts_of(SEPARATORS.index(sep))
        allowed = F.greatest(counts[0], F.coalesce(F.get(counts, F.lit(1)), F.lit(0)))
        score = F.when(F.forall(counts, lambda n: n <= allowed), counts[0]).otherwise(0)
        # equal scores: the earlier separator has the greater tie break
        entry = F.struct(score.alias("n_columns"), F.lit(-SEPARATORS.index(sep)).alias("tie"), F.lit(sep).alias("sep"))
        best = entry if best is None else F.greatest(best, entry)
    return rows.withColumns({"separator": best["sep"], "n_columns": best["n_columns"]}).select(
        "path",
        file_year(F.col("path")).alias("year"),
        F.when(F.col("utf8"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
        "separator",
        "n_columns",
        multi_line.alias("multi_line"),
        "header",
        "physical_lines",
    )


def has_known_column() -> Column:
    """Whether the header of a probed file names any expected column."""
    names = F.transform(F.split("header", F.col("separator")), lambda n: F.btrim(n, F.lit('"')))
    return F.arrays_overlap(names, F.array(*[F.lit(c) for c in CERTIFICATE_COLUMNS]))


def land_chunks(
    spark: SparkSession, paths: str | list[str], folder: str, years: tuple[int, int] | None = None, recursive: bool = True
) -> DataFrame:
    """The files of all years, or of an inclusive range, as a stored table of chunks; files of other years are never opened."""
    where = file_year(F.col("_metadata.file_path")).between(*years) if years else None
    chunks = chunks_of(spark, paths, where, recursive)
    chunks.write.mode("overwrite").parquet(folder)
    return spark.read.schema(chunks.schema).parquet(folder)


def scan(spark: SparkSession, dialects: DataFrame) -> DataFrame:
    """Probed files as strings, all in one read (see `records_of`), with the year of the file.

    Unknown columns are left out (P1); a file without any known column is not read. Only the folders of the files
    and the names of known columns reach the driver. An import lands the chunks once and has
    dialects and records from them: `land_chunks`, `dialects_of`, `scan_chunks`.
    """
    folders = [r[0] for r in dialects.select(F.regexp_extract("path", "(?s)^(.*)/", 1)).distinct().collect()]
    if not folders:
        raise ValueError("no file to read")
    return scan_chunks(land_chunks(spark, folders, scratch_dir(spark, "chunks"), recursive=False), dialects)


def scan_chunks(chunks: DataFrame, dialects: DataFrame) -> DataFrame:
    return records_of(chunks, dialects).withColumn("year", file_year(F.col("source_path")))


def profile(dialects: DataFrame, scanned: DataFrame) -> DataFrame:
    """S3: per file the dialect, the column list and the number of records."""
    counts = scanned.groupBy(F.col("source_path").alias("path")).agg(F.count("*").alias("total_rows"))
    return dialects.join(counts, "path", "left").select(
        "path", "year", "encoding", "separator", "n_columns", "header",
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
    )


def sample_records(scanned: DataFrame, n: int = 3) -> DataFrame:
    """S3: the first n records of each file."""
    order = Window.partitionBy("source_path").orderBy("source_block", "source_row")
    return scanned.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)


def landed_files(files: DataFrame) -> DataFrame:
    """Year, name and size of each yearly file, with the grand total as the row without a year.

    Sizes are summed once per file first, so the roll-up only sees the listing.
    """
    listed = files.select(
        F.regexp_extract("full_path", YEAR_PATTERN, 1).alias("year"), "filename", "file_size"
    ).filter(F.col("year") != "")
    return (
        listed.groupBy("year", "filename")
        .agg(F.sum("file_size").alias("bytes"))
        .rollup(F.struct("year", "filename").alias("file"))
        .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
        .select(
            F.col("file.year").alias("year"), F.col("file.filename").alias("filename"), "files", "bytes",
            F.round(F.col("bytes") / 1024 / 1024, 1).alias("mb"),
        )
    )


def latest_per_year(files: DataFrame, year: Column) -> DataFrame:
    """Newest file of each year and how many there are.

    `max_by` is merged map-side. The list of all matches is never gathered into one
    row: see `mark_latest`.
    """
    return (
        files.withColumn("year", year)
        .groupBy("year")
        .agg(
            F.max_by("full_path", F.struct("modified", "full_path")).alias("latest_path"),
            F.max("modified").alias("latest_modified"),
            F.count("*").alias("matching_files"),
        )
    )


def mark_latest(files: DataFrame, year: Column) -> DataFrame:
    """Every matching file with its year and whether it is the newest one."""
    latest = latest_per_year(files, year).select("year", "latest_path")
    return files.withColumn("year", year).join(latest, "year", "left").withColumn(
        "is_latest", F.col("full_path") == F.col("latest_path")
    ).drop("latest_path")
