"""Monitoring reports and top lists.

Groups here are statuses, days, years and versions. Each report is one
aggregation with map-side merging; totals are rolled up from the grouped rows and
not from the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from certflow.functions.answers import PLACEHOLDER, SECTIONS
from certflow.functions.scalars import not_blank, preview, whole_mb
from certflow.operators.skew import salted_join
from certflow.operators.worklists import top


def status_breakdown(log: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """A1: calls and records per status of one batch; the row without a status is the total."""
    rows = log if batch_time is None else log.filter(F.col("LogDate") == batch_time)
    grouped = rows.groupBy("status_message").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("records_returned", F.lit(0))).alias("r")
    )
    return grouped.rollup("status_message").agg(F.sum("n").alias("calls"), F.sum("r").alias("records"))


def answer_completeness(answers: DataFrame, version: str | None = None) -> DataFrame:
    """A2: answers per version and how many have each section.

    A placeholder counts as present in `has_*`; `real_*` leaves it out.
    """
    rows = answers if version is None else answers.filter(F.col("PromptVersion") == version)
    names = {"AboutEstate": "about_estate", "Positives": "positives", "Evaluation": "evaluation"}
    has = {s: not_blank(F.col(s)) for s in SECTIONS}
    report = rows.groupBy("PromptVersion").agg(
        F.count("*").alias("total_responses"),
        F.min("Created").alias("first_processed"),
        F.max("Created").alias("last_processed"),
        *[F.count_if(has[s]).alias(f"has_{names[s]}") for s in SECTIONS],
        *[F.count_if(has[s] & (F.col(s) != PLACEHOLDER)).alias(f"real_{names[s]}") for s in SECTIONS],
    )
    return report.withColumns({
        f"pct_{n}": F.round(F.col(f"has_{n}") / F.col("total_responses") * 100, 4) for n in names.values()
    })


def whole_average(c: Column) -> Column:
    """AVG of an integer column as T-SQL gives it: cut to a whole number."""
    return F.avg(c).cast("long")


def extraction_stats(extracts: DataFrame) -> DataFrame:
    """A3: extracts per status with average characters and pages."""
    return extracts.groupBy("extraction_status").agg(
        F.count("*").alias("extracts"),
        whole_average(F.col("character_count")).alias("avg_chars"),
        whole_average(F.col("page_count")).alias("avg_pages"),
    )


def download_stats(log: DataFrame) -> DataFrame:
    """A4: downloads per status with their average size, most frequent first."""
    return (
        log.groupBy("status")
        .agg(F.count("*").alias("downloads"), whole_average(F.col("file_size")).alias("avg_size"))
        .orderBy(F.desc("downloads"), "status")
    )


def daily_success(log: DataFrame) -> DataFrame:
    """A5: attempts and success rate per day.

    `success_rate` counts every attempt; `rate_without_skipped` leaves out files that
    were already there.
    """
    ok = F.count_if(F.col("status") == "Success")
    tried = F.count_if(F.col("status") != "Already Exists")
    return (
        log.groupBy(F.to_date("download_date").alias("day"))
        .agg(F.count("*").alias("attempts"), ok.alias("successful"), tried.alias("not_skipped"))
        .withColumn("success_rate", (F.col("successful") * 100 / F.col("attempts")).cast("decimal(5,2)"))
        .withColumn(
            "rate_without_skipped",
            F.when(F.col("not_skipped") > 0, F.col("successful") * 100 / F.col("not_skipped")).cast("decimal(5,2)"),
        )
        .orderBy(F.desc("day"))
    )


def files_per_day(inventory: DataFrame) -> DataFrame:
    """Files added per day."""
    return inventory.groupBy(F.to_date("sync_date").alias("day")).agg(F.count("*").alias("files_added")).orderBy(F.desc("day"))


def duplicate_names(inventory: DataFrame) -> DataFrame:
    """File names that occur more than once."""
    return inventory.groupBy("filename").agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def coverage(extracts: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Extracts with their cleaned text, if any."""
    return extracts.join(cleaned, "file_id", "left")


def cleaning_coverage(extracts: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Total, cleaned and pending extracts. Only keys are joined."""
    keys = cleaned.filter(F.col("clean_text").isNotNull()).select("file_id").withColumn("_done", F.lit(True))
    joined = coverage(extracts.select("file_id"), keys)
    return joined.agg(
        F.count("*").alias("total_records"),
        F.count("_done").alias("cleaned_records"),
        F.count_if(F.col("_done").isNull()).alias("pending_records"),
    )


def directory_stats(listing: DataFrame) -> DataFrame:
    """Files and bytes per suffix; the row without a suffix name is the total."""
    return (
        listing.groupBy("file_extension")
        .agg(F.count("*").alias("n"), F.sum("file_size").alias("b"))
        .rollup("file_extension")
        .agg(F.sum("n").alias("files"), F.sum("b").alias("bytes"))
        .withColumn("mb", F.round(F.col("bytes") / 1024 / 1024, 1))
    )


def sample_files(listing: DataFrame, extension: str = ".pdf", n: int = 5) -> DataFrame:
    """The first files of one suffix by name, with their size in MB."""
    rows = listing.filter(F.col("file_extension") == extension)
    mb = F.round(F.col("file_size") / 1024 / 1024, 1)
    return top(rows, ["filename", "full_path"], n).select("filename", mb.alias("mb"))


def import_summary(
    staged: DataFrame, stored: DataFrame, key: str, failed: Column | None = None, within: list[str] | None = None
) -> DataFrame:
    """A10: totals of an import, from the keys alone and in one job.

    Copies of a key are counted map-side; rows without a key count as one, or as one
    per value of the `within` columns, and are always new. `stored_matches` counts
    stored rows, `skipped_rows` incoming keys.
    """
    bad = F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)
    keys = staged.groupBy(key, *(within or [])).agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    have = stored.groupBy(key).agg(F.count("*").alias("matches"))
    usable = F.col("good") > 0
    totals = salted_join(keys, have, [key], "left", None).agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("failed_rows"),
        F.count_if(usable).alias("distinct_rows"),
        F.count_if(usable & F.col("matches").isNotNull()).alias("skipped_rows"),
        F.coalesce(F.sum(F.when(usable, F.col("matches"))), F.lit(0)).alias("stored_matches"),
    )
    new = F.col("distinct_rows") - F.col("skipped_rows")
    tried = new + F.col("failed_rows")
    return totals.select(
        (F.col("good") + F.col("failed_rows")).alias("total_rows"),
        (F.col("good") - F.col("distinct_rows")).alias("duplicate_rows"),
        new.alias("inserted_rows"),
        "skipped_rows",
        "stored_matches",
        "failed_rows",
        F.when(tried > 0, F.round(new / tried * 100, 4)).otherwise(100.0).alias("insert_rate"),
        ((new > 0) | (F.col("skipped_rows") > 0)).alias("success"),
    )


def stage_report(rows: DataFrame, stage: str, ok: Column, seconds: float | None = None) -> DataFrame:
    """Processed, successful and failed rows of a stage, with rates."""
    counts = rows.agg(F.count("*").alias("processed"), F.count_if(ok).alias("successful"))
    rate = F.when(F.col("processed") > 0, F.round(F.col("successful") / F.col("processed") * 100, 4))
    out = counts.select(
        F.lit(stage).alias("stage"), "processed", "successful",
        (F.col("processed") - F.col("successful")).alias("failed"), rate.alias("success_pct"),
    )
    if seconds is not None:
        out = out.withColumns({
            "seconds": F.lit(float(seconds)),
            "rows_per_second": F.round(F.col("processed") / F.lit(max(float(seconds), 1e-9)), 4),
        })
    return out


def compression(rows: DataFrame, by: str, before: Column, after: Column) -> DataFrame:
    """Texts, characters and reduction in percent per group."""
    pct = F.when(before > 0, (before - after) / before * 100)
    return rows.groupBy(by).agg(
        F.count("*").alias("texts"),
        F.sum(before.cast("long")).alias("chars_before"),
        F.sum(after.cast("long")).alias("chars_after"),
        F.round(F.min(pct), 4).alias("min_pct"),
        F.round(F.avg(pct), 4).alias("avg_pct"),
        F.round(F.max(pct), 4).alias("max_pct"),
    )


def year_summary(files: DataFrame, ok: Column) -> DataFrame:
    """Years that worked and years that failed. A year fails if any of its files does.

    The lists are built from one row per year.
    """
    years = files.groupBy("year").agg(F.bool_and(ok).alias("ok"))
    return years.agg(
        F.sort_array(F.collect_list(F.when(F.col("ok"), F.col("year")))).alias("successful_years"),
        F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("year")))).alias("failed_years"),
        F.bool_and("ok").alias("total_success"),
    )


def landing_summary(landing: DataFrame) -> DataFrame:
    """Years tried, downloaded, skipped and failed, from one landing row per year."""
    return landing.agg(
        F.count("*").alias("total_years"),
        F.count_if(F.col("outcome") == "downloaded").alias("successful_downloads"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_existing"),
        F.count_if(F.col("outcome") == "failed").alias("failed_downloads"),
    )


def answers_view(answers: DataFrame) -> DataFrame:
    """Answers with all three real sections, trimmed, for dashboards."""
    valid = [not_blank(F.col(s)) & (F.trim(s) != PLACEHOLDER) for s in SECTIONS]
    return answers.filter(valid[0] & valid[1] & valid[2]).select(
        "file_id", "PromptVersion", *[F.trim(s).alias(s) for s in SECTIONS],
        F.length(F.trim("Evaluation")).alias("EvaluationLength"),
        F.col("Created").alias("ProcessedDate"),
    )


def answer_trend(view: DataFrame) -> DataFrame:
    """Answers per month and version."""
    return view.groupBy(F.date_trunc("month", "ProcessedDate").alias("month"), "PromptVersion").agg(
        F.count("*").alias("answers"), whole_average(F.col("EvaluationLength")).alias("avg_evaluation_chars")
    )


def rating_distribution(certificates: DataFrame, ratings: DataFrame, column: str) -> DataFrame:
    """Certificates per rating. Counted first, then named from the static table."""
    counts = certificates.groupBy(column).agg(F.count("*").alias("certificates"))
    return counts.join(F.broadcast(ratings), counts[column] == ratings["RatingCode"], "left").select(
        column, "RatingName", "SortOrder", "certificates"
    )


def recent_extractions(extracts: DataFrame, n: int = 10) -> DataFrame:
    """T1."""
    return top(extracts, [F.desc("extraction_date"), "file_id"], n).select(
        "file_id", "filename", "character_count", "page_count", "extraction_status", "extraction_date"
    )


def longest_texts(extracts: DataFrame, n: int = 3) -> DataFrame:
    """Previews of the longest successful texts."""
    rows = extracts.filter(F.col("extraction_status") == "SUCCESS")
    rows = rows.select("file_id", "filename", "character_count", preview(F.col("extracted_text")).alias("text_sample"))
    return top(rows, [F.desc("character_count"), "file_id"], n)


def largest_files(inventory: DataFrame, n: int = 10) -> DataFrame:
    """T3."""
    return top(inventory, [F.desc("file_size"), "file_id"], n).select(
        "file_id", "filename", whole_mb(F.col("file_size")).alias("size_mb"), "sync_date"
    )


def recent_downloads(log: DataFrame, n: int = 20) -> DataFrame:
    """T4."""
    return top(log, [F.desc("download_date"), "attest_url"], n).select(
        "filename", "status", "status_message", whole_mb(F.col("file_size")).alias("size_mb"), "download_date"
    )


def sample_answers(answers: DataFrame, version: str, n: int = 5) -> DataFrame:
    """T5."""
    rows = answers.filter(F.col("PromptVersion") == version)
    return top(rows, [F.desc("Created"), "file_id"], n).select("file_id", *SECTIONS, "Created")


def recent_cleaning(extracts: DataFrame, cleaned: DataFrame, n: int = 10) -> DataFrame:
    """Newest extracts with their cleaned length.

    Each extract gives at least one row of the left join, so the list is cut before
    the join as well as after it, and only n keys meet the cleaned table.
    """
    newest = top(extracts.select("file_id", "filename", "extraction_date"), [F.desc("extraction_date"), "file_id"], n)
    lengths = cleaned.select("file_id", "cleaned_date", F.length("clean_text").alias("cleaned_length"))
    order = [F.desc("extraction_date"), "file_id", "cleaned_date"]
    return top(newest.join(lengths, "file_id", "left"), order, n)


def last_months(view: DataFrame, as_of: Column, months: int = 3, n: int = 100) -> DataFrame:
    """Newest rows of the last months."""
    since = as_of - F.make_interval(months=F.lit(months))
    return top(view.filter(F.col("ProcessedDate") >= since), [F.desc("ProcessedDate"), "file_id"], n)
