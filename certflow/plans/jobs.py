"""The stages as jobs over landed data and stage tables below one root folder.

Each job stages what it needs more than once as a table, so later writes and reports
do not compute it again and a lost executor only repeats tasks. Times are arguments.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from certflow.functions.answers import parse_answer
from certflow.functions.text import clean_text
from certflow.operators.conform import conform, keep_first
from certflow.operators.lifecycle import PENDING, expire_pending, log_pending, purge_gone, resolve_pending
from certflow.operators.outcomes import cleaning_outcome, download_outcome, extraction_outcome, reduction_pct
from certflow.operators.quantiles import quantiles, sketch
from certflow.operators.reports import import_summary, stage_report, status_breakdown, year_summary
from certflow.operators.responses import call_outcomes, flatten, parse_bodies
from certflow.operators.spread import spread
from certflow.operators.worklists import (
    api_worklist, clean_worklist, extract_worklist, new_files, new_records, not_done, prompt_worklist, url_worklist,
)
from certflow.schemas import (
    ANSWERS, API_LOG, CERTIFICATE_COLUMNS, CERTIFICATE_KEY, CLEANED_TEXT, CLEANING_SKETCH, DOWNLOAD_LOG, FILE_EXTRACT,
    FILE_INVENTORY, IMPORTED, QUARANTINE,
)
from certflow.sources.landing import POSITION, dialects_of, has_known_column, land_chunks, scan_chunks
from certflow.sources.tables import append_batch, pinned_version, read_batches, read_version, write_version

# Why a row is kept apart from an import.
TOO_MANY_FIELDS, OPEN_QUOTE = "more fields than the header", "quote without an end"


def _as(df: DataFrame, schema) -> DataFrame:
    """Columns, order and types of a stage table; a column that is absent is null."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def import_certificates(
    spark: SparkSession, path: str | list[str], root: str, batch: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """Landed CSV files, of all years or of an inclusive range, to new certificate rows; gives A10.

    The files are read once, into stored chunks, which give both dialects and records. The conformed rows
    are staged with their place in the file, so 'first' means the same in every later read: by year, then by
    place. Rows with too many fields, or with a quote that is never closed, go to the table `quarantine`, as they were read and
    with the reason. A file without any known column is skipped and stops nothing else.
    """
    chunks = land_chunks(spark, path, f"{root}/landed/batch={batch}", years)
    dialects = append_batch(dialects_of(chunks), root, "dialects", batch)
    read = scan_chunks(chunks, dialects)
    known = [c for c in CERTIFICATE_COLUMNS if c in read.columns]
    reason = F.when(F.col("unclosed"), OPEN_QUOTE).when(F.col("overflow").isNotNull(), TOO_MANY_FIELDS)
    read = read.withColumn("reason", reason).withColumn(
        "record", F.when(F.col("reason").isNotNull(), F.to_json(F.struct(*known, "overflow"))))
    rows = conform(read, [*POSITION, "year", "keyed", "reason", "record"])
    if CERTIFICATE_KEY not in rows.columns:
        rows = rows.withColumn(CERTIFICATE_KEY, F.lit(None).cast("string"))
    staged = append_batch(rows.withColumn("unit", _unit_without_key()), root, "staged", batch)
    append_batch(_as(staged.filter(F.col("reason").isNotNull()), QUARANTINE), root, "quarantine", batch)
    stored = read_batches(spark, root, "imported", IMPORTED, skip=batch)
    good = staged.filter(F.col("reason").isNull())
    first = keep_first(good, [CERTIFICATE_KEY, "unit"], ["year", *POSITION])
    append_batch(_as(new_records(first, stored, CERTIFICATE_KEY), IMPORTED), root, "imported", batch)
    return import_summary(staged, stored, CERTIFICATE_KEY, F.col("reason").isNotNull(), ["unit"])


def _unit_without_key() -> Column:
    """What a row without a key is a copy within: its year's file, or nothing if that file has no key column."""
    year = F.coalesce(F.col("year").cast("string"), F.col("source_path"))
    return F.when(F.col(CERTIFICATE_KEY).isNull(), F.when(F.col("keyed"), year).otherwise(
        F.concat_ws("/", "source_path", "source_block", "source_row")))


def imported_years(spark: SparkSession, root: str, batch: str, years: tuple[int, int]) -> DataFrame:
    """A14 after an import: a year failed when it has no file or one without any known column."""
    wanted = spark.range(years[0], years[1] + 1).select(F.col("id").cast("int").alias("year"))
    files = spark.read.parquet(f"{root}/dialects/batch={batch}").select("year", has_known_column().alias("ok"))
    return year_summary(wanted.join(files, "year", "left"), F.coalesce("ok", F.lit(False)))


def process_responses(
    certificates: DataFrame, responses: DataFrame, root: str, batch: str,
    batch_time: datetime, n: int | None = None, stale_hours: int = 1,
) -> DataFrame:
    """Worklist, landed responses, flat certificate rows and the call log; gives A1.

    Pending rows live in a small table of their own. Resolved rows are only ever
    appended, so the long log is never rewritten. Batches run in the order of their names;
    a batch that is run again reads what its first run read.
    """
    spark = certificates.sparkSession
    now = F.lit(batch_time)
    log = read_batches(spark, root, "api_log", API_LOG, skip=batch)
    waiting = expire_pending(read_version(spark, root, "api_pending", API_LOG, batch), now, stale_hours)
    work = api_worklist(certificates, log.select("CertificateID").union(waiting.select("CertificateID")), n)
    # a landed response may answer a call of this batch or one that still waits
    columns = work.columns
    open_calls = work.unionByName(waiting.select(*columns).dropDuplicates(["CertificateID"]))
    landed = keep_first(responses, ["CertificateID"], [c for c in responses.columns if c != "CertificateID"])
    calls = append_batch(
        open_calls.join(landed.withColumn("answered", F.lit(True)), "CertificateID", "left"), root, "api_calls", batch
    )
    parsed = parse_bodies(calls.filter("answered"))
    append_batch(flatten(parsed, now), root, "certificates", batch)
    fresh = log_pending(new_records(calls.select(*columns), waiting, "CertificateID"), now)
    resolved = resolve_pending(waiting.unionByName(fresh), call_outcomes(parsed))
    whole = append_batch(resolved, root, "api_resolved", batch)
    append_batch(whole.filter(F.col("status_message") != PENDING), root, "api_log", batch)
    write_version(whole.filter(F.col("status_message") == PENDING), root, "api_pending", batch)
    return status_breakdown(whole, now)


def record_downloads(
    urls: DataFrame, attempts: DataFrame, root: str, batch: str, batch_time: datetime, n: int | None = None
) -> DataFrame:
    """P15 over landed download attempts of the URL worklist, appended to the download log.

    The inventory is that of the newest scan when the batch first ran.
    """
    spark, start = urls.sparkSession, time.perf_counter()
    log = read_batches(spark, root, "download_log", DOWNLOAD_LOG, skip=batch)
    inventory = pinned_version(spark, root, "inventory", FILE_INVENTORY, "download_log", batch)
    tried = url_worklist(urls, inventory, log, n).join(attempts, "attest_url")
    rows = tried.select(
        "attest_url", F.col("expected_filename").alias("filename"), F.lit(batch_time).alias("download_date"),
        *download_outcome(*[F.col(c) for c in (
            "exists", "existing_size", "http_status", "http_error", "error", "content_length", "content_head", "size",
        )]),
        "http_status", F.lit(batch_time).alias("created"),
    )
    # no request was answered where the file was there already or the client failed
    code = F.when(~F.col("status").isin("Already Exists", "Error"), F.col("http_status"))
    rows = rows.withColumn("http_status_code", code)
    written = append_batch(_as(rows, DOWNLOAD_LOG), root, "download_log", batch)
    return stage_report(written, "download", F.col("status").isin("Success", "Already Exists"), time.perf_counter() - start)


def sync_inventory(
    listing: DataFrame, root: str, batch_time: datetime, skip_existing: bool = True, cleanup: bool = True
) -> DataFrame:
    """Drop rows of files that are gone, add new files; gives the counts.

    A forced run (skip_existing false) writes all listed files anew; their rows replace those of
    the same path. The id of a file is the SHA-256 of its path. A run of the same time again
    reads what its first run read.
    """
    spark = listing.sparkSession
    batch = batch_time.strftime("%Y%m%dT%H%M%S%f")
    before = read_version(spark, root, "inventory", FILE_INVENTORY, batch)
    kept = purge_gone(before, listing) if cleanup else before
    added = new_files(listing, kept, skip_existing).select(
        F.sha2("full_path", 256).alias("file_id"), "filename", "full_path", "file_size", "file_extension",
        F.lit(batch_time).alias("sync_date"), F.lit(True).alias("_new"),
    )
    added = keep_first(added, ["full_path"], ["filename"])
    rest = kept if skip_existing else not_done(kept, added, ["full_path"])
    rows = rest.withColumn("_new", F.lit(False)).unionByName(added)
    staged = append_batch(rows, root, "inventory_staged", batch)
    write_version(_as(staged, FILE_INVENTORY), root, "inventory", batch)
    n = lambda df, c="*": df.agg(F.count(c).alias("n"))
    total, old = n(listing).withColumnRenamed("n", "files_processed"), n(before).withColumnRenamed("n", "before")
    still, now = n(kept).withColumnRenamed("n", "kept"), staged.agg(F.count_if("_new").alias("files_added"))
    # four one-row frames side by side
    joined = total.withColumn("k", F.lit(1))
    for one in (old, still, now):
        joined = joined.join(one.withColumn("k", F.lit(1)), "k")
    return joined.select(
        "files_processed", "files_added",
        (F.col("files_processed") - F.col("files_added")).alias("files_skipped"),
        (F.col("before") - F.col("kept")).alias("files_deleted"),
    )


def record_extracts(
    parsed_files: DataFrame, root: str, batch: str, batch_time: datetime, n: int | None = None
) -> DataFrame:
    """P16 over landed parser output of the extract worklist, appended to the extract table.

    The inventory is that of the newest scan when the batch first ran.
    """
    spark, start = parsed_files.sparkSession, time.perf_counter()
    done = read_batches(spark, root, "extracts", FILE_EXTRACT, skip=batch)
    inventory = pinned_version(spark, root, "inventory", FILE_INVENTORY, "extracts", batch)
    work = extract_worklist(inventory, done, n).select("file_id", "filename", "full_path", "file_size")
    rows = work.join(parsed_files, "full_path").select(
        "file_id", "filename",
        *extraction_outcome(F.col("full_path"), F.col("exists"), F.col("file_size"), F.col("text"), F.col("error")),
        F.lit(batch_time).alias("extraction_date"), F.lit("landed").alias("extraction_method"), "page_count",
    )
    written = append_batch(_as(rows, FILE_EXTRACT), root, "extracts", batch)
    return stage_report(written, "extract", F.col("extraction_status") == "SUCCESS", time.perf_counter() - start)


def cleaned_rows(
    extracts: DataFrame, aggressive: bool = False, patterns: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """X12 and P17 on each extract, with both lengths and the reduction."""
    clean = clean_text(F.col("extracted_text"), aggressive, patterns)
    rows = spread(extracts.select("file_id", "extracted_text"), "file_id", partitions).withColumn("clean_text", clean)
    before, after = F.length("extracted_text"), F.length("clean_text")
    return rows.select(
        "file_id", "clean_text",
        cleaning_outcome(F.col("extracted_text"), F.col("clean_text")).alias("outcome"),
        before.cast("long").alias("original_count"),
        after.cast("long").alias("character_count"),
        F.round(reduction_pct(before, after), 4).alias("reduction_pct"),
    )


def clean_texts(
    extracts: DataFrame, root: str, batch: str, batch_time: datetime,
    n: int | None = None, aggressive: bool = False, patterns: list[str] | None = None, partitions: int | None = None,
) -> DataFrame:
    """C4: extracts that are not cleaned yet, in one pass; failed ones come back next time.

    Sketches of the reduction in percent are stored by outcome, for percentiles over any batches.
    """
    spark, start = extracts.sparkSession, time.perf_counter()
    done = read_batches(spark, root, "cleaned", CLEANED_TEXT, skip=batch)
    extracts = extracts.withColumn("file_id", F.col("file_id").cast("string"))
    rows = cleaned_rows(clean_worklist(extracts, done, n), aggressive, patterns, partitions)
    results = append_batch(rows.withColumn("cleaned_date", F.lit(batch_time)), root, "cleaning_results", batch)
    append_batch(_as(results.filter(F.col("outcome") == "success"), CLEANED_TEXT), root, "cleaned", batch)
    append_batch(_as(sketch(results, ["outcome"], "reduction_pct"), CLEANING_SKETCH), root, "cleaning_sketches", batch)
    return stage_report(results, "clean", F.col("outcome") == "success", time.perf_counter() - start)


def cleaning_percentiles(spark: SparkSession, root: str, shares: list[float]) -> DataFrame:
    """Percentiles of the reduction in percent by outcome over all batches, from their stored sketches alone."""
    stored = read_batches(spark, root, "cleaning_sketches", CLEANING_SKETCH)
    return quantiles(stored, ["outcome"], shares)


def parse_answers(
    prompts: DataFrame, responses: DataFrame, root: str, batch: str, batch_time: datetime,
    version: str, n: int | None = None, partitions: int | None = None,
) -> DataFrame:
    """Landed model responses of the prompt worklist to stored sections."""
    spark, start = prompts.sparkSession, time.perf_counter()
    done = read_batches(spark, root, "answers", ANSWERS, skip=batch)
    prompts = prompts.withColumn("FILE_ID", F.col("FILE_ID").cast("string"))
    responses = responses.withColumn("file_id", F.col("file_id").cast("string"))
    work = prompt_worklist(prompts, done, version, n).select("file_id", "prompt_version")
    tried = spread(work, "file_id", partitions).join(responses, ["file_id", "prompt_version"], "left")
    parsed = tried.withColumn("parsed", parse_answer(F.col("response_text"))).select(
        F.sha2(F.concat_ws("\n", "prompt_version", "file_id"), 256).alias("openAIAnswerID"), "file_id",
        F.col("prompt_version").alias("PromptVersion"), "parsed.*",
        F.lit(batch_time).alias("Created"), F.col("response_text").isNotNull().alias("answered"),
    )
    results = append_batch(parsed, root, "answer_results", batch)
    append_batch(_as(results.filter("answered"), ANSWERS), root, "answers", batch)
    return stage_report(results, "answer", F.col("answered"), time.perf_counter() - start)


def run_stages(
    spark: SparkSession, stages: dict[str, Callable[[], DataFrame | None]], root: str, batch: str
) -> DataFrame:
    """Run stages in order; a failing one does not stop the rest. One row per stage.

    A stage's report is stored whole, as the batch's part of the table `reports/<stage>`; the
    row holds its place, and whether the stage worked, its seconds and its error text.
    """
    rows = []
    for name, stage in stages.items():
        start = time.perf_counter()
        try:
            report = stage()
            if report is not None:
                append_batch(report, root, f"reports/{name}", batch)
            place = None if report is None else f"{root}/reports/{name}/batch={batch}"
            rows.append((name, True, None, place, time.perf_counter() - start))
        except Exception as error:  # noqa: BLE001 - any failure is a result of the stage
            rows.append((name, False, str(error)[:200], None, time.perf_counter() - start))
    return spark.createDataFrame(rows, "stage string, success boolean, error string, report string, seconds double")
