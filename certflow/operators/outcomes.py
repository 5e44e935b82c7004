"""The outcome of each row of a stage, as one ordered CASE each."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from certflow.functions.scalars import MB
from certflow.functions.text import MIN_CLEAN_CHARS, MIN_RAW_CHARS, strip

# Limits and status texts.
MAX_BYTES = 50 * MB
MIN_PDF_BYTES = 1024
TOO_MANY = "Too many results (25+ eiendommer)"
NOTHING = "No records found"
NOT_SAVED = "API returned data but no records saved"


def _count(c: Column) -> Column:
    return F.format_number(c, 0)


def call_outcome(
    http_status: Column, body: Column, returned: Column, saved: Column, error: Column
) -> list[Column]:
    """Status text, number of records and a finer detail of one call.

    A failed request and an empty list have the same status text; the detail tells
    them apart.
    """
    errors = F.get_json_object(body, "$.errors.EnergiattestResponse")
    too_many = (http_status == 400) & F.coalesce(F.lower(errors).contains("more than twenty five"), F.lit(False))
    failed = F.coalesce(http_status != 200, F.lit(True))
    n = F.coalesce(returned, F.lit(0))
    status = (
        F.when(error.isNotNull(), F.concat(F.lit("Error: "), F.left(error, F.lit(200))))
        .when(too_many, TOO_MANY)
        .when(failed | (n == 0), NOTHING)
        .when(F.coalesce(saved, F.lit(0)) > 0, "Success")
        .otherwise(NOT_SAVED)
    )
    detail = (
        F.when(error.isNotNull(), "error").when(too_many, "too_many").when(failed, "http_failure")
        .when(n == 0, "empty").when(F.coalesce(saved, F.lit(0)) > 0, "saved").otherwise("not_saved")
    )
    records = F.when(error.isNotNull() | failed, 0).otherwise(n).cast("long")
    return [records.alias("records_returned"), status.alias("status_message"), detail.alias("outcome_detail")]


def download_outcome(
    exists: Column, existing_size: Column, http_status: Column, http_error: Column,
    error: Column, content_length: Column, head: Column, size: Column,
) -> list[Column]:
    """Status and message of a download; `head` is the start of the content, as text."""
    start = F.lower(F.left(head, F.lit(100)))
    page = (size < MIN_PDF_BYTES) & (start.contains("<html") | start.contains("error"))
    failed = http_error.isNotNull() | F.coalesce(http_status >= 400, F.lit(False))
    large = F.coalesce(content_length > MAX_BYTES, F.lit(False))
    cases = [
        (exists, "Already Exists", F.concat(F.lit("File already exists ("), _count(existing_size), F.lit(" bytes)")),
         existing_size),
        (failed, "HTTP Error",
         F.concat(F.lit("HTTP request failed: "), F.coalesce(http_error, F.concat(F.lit("status "), http_status.cast("string")))),
         F.lit(None)),
        (error.isNotNull(), "Error", F.concat(F.lit("Unexpected error: "), error), F.lit(None)),
        (large, "File Too Large",
         F.concat(F.lit("File too large: "), _count(content_length), F.lit(" bytes (max 50MB)")), content_length),
        (page, "Invalid Content", F.lit("Downloaded file appears to be an error page, not a PDF"), size),
        (F.lit(True), "Success", F.concat(F.lit("Downloaded successfully ("), _count(size), F.lit(" bytes)")), size),
    ]
    status = message = bytes_ = None
    for test, name, text, n in cases:
        status = F.when(test, name) if status is None else status.when(test, name)
        message = F.when(test, text) if message is None else message.when(test, text)
        bytes_ = F.when(test, n) if bytes_ is None else bytes_.when(test, n)
    return [status.alias("status"), message.alias("status_message"), bytes_.cast("long").alias("file_size")]


def extraction_outcome(
    path: Column, exists: Column, file_size: Column, text: Column, error: Column
) -> list[Column]:
    """Stored text, status and character count of an extraction.

    Everything but a full success is stored as FAILED; `detail_status` keeps the cause.
    """
    short = F.length(strip(F.coalesce(text, F.lit("")))) < MIN_RAW_CHARS
    cases = [
        (~exists, "FILE_NOT_FOUND", F.concat(F.lit("File not found: "), path)),
        (F.coalesce(file_size > MAX_BYTES, F.lit(False)), "FILE_TOO_LARGE",
         F.concat(F.lit("File too large: "), _count(file_size), F.lit(f" bytes (max {MAX_BYTES:,} bytes)"))),
        (error.isNotNull(), "EXTRACTION_ERROR", F.concat(F.lit("Text extraction failed: "), error)),
        (short, "SUCCESS_LOW_CONTENT",
         F.concat(F.lit("Extracted text too short ("), F.length(F.coalesce(text, F.lit(""))).cast("string"), F.lit(" chars)"))),
    ]
    detail = message = None
    for test, name, why in cases:
        detail = F.when(test, name) if detail is None else detail.when(test, name)
        message = F.when(test, why) if message is None else message.when(test, why)
    return [
        F.coalesce(F.concat(F.lit("EXTRACTION FAILED: "), message), text).alias("extracted_text"),
        F.when(message.isNull(), "SUCCESS").otherwise("FAILED").alias("extraction_status"),
        F.when(message.isNull(), F.length(text)).otherwise(0).cast("long").alias("character_count"),
        detail.otherwise("SUCCESS").alias("detail_status"),
    ]


def cleaning_outcome(raw: Column, cleaned: Column) -> Column:
    """P17: 'success', or which of the two length checks failed."""
    return (
        F.when(F.length(strip(F.coalesce(raw, F.lit("")))) < MIN_RAW_CHARS, "raw_too_short")
        .when(F.length(strip(F.coalesce(cleaned, F.lit("")))) < MIN_CLEAN_CHARS, "cleaned_too_short")
        .otherwise("success")
    )


def reduction_pct(before: Column, after: Column) -> Column:
    """Share of characters removed, in percent; null for an empty original."""
    return F.when(before > 0, (before - after) / before * 100)
