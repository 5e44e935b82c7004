"""Outcomes, statistics, top lists and catalog: P15-P17, P19, A2-A8, A13, A16, T1-T7, S10, S11."""

from __future__ import annotations

from pyspark.sql import functions as F

from certflow.functions.answers import PLACEHOLDER
from certflow.operators import reports as R
from certflow.operators.outcomes import download_outcome, extraction_outcome
from certflow.plans.queries.registry import query, table
from certflow.sources.dims import RATINGS, ratings
from certflow.sources.tables import data_dictionary, row_counts

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Pages as download attempts; both engines read these expressions alike.
ATTEMPTS = [
    "page_id", "url AS attest_url",
    "page_id % 10 = 0 AS file_there",
    "CAST(page_id * 1000 AS BIGINT) AS existing_size",
    "CASE WHEN page_id % 10 = 1 THEN 404 WHEN page_id % 10 = 2 THEN NULL ELSE 200 END AS http_status",
    "CASE WHEN page_id % 10 = 2 THEN 'connection reset' END AS http_error",
    "CASE WHEN page_id % 10 = 3 THEN 'disk full' END AS failure",
    "CAST(CASE WHEN page_id % 10 = 4 THEN 52428801 WHEN page_id % 10 = 5 THEN 52428800 END AS BIGINT) AS content_length",
    "CASE WHEN page_id % 10 = 6 THEN concat('plain ', html) ELSE html END AS content",
    "CAST(CASE WHEN page_id % 3 = 0 THEN 1024 ELSE length(html) END AS BIGINT) AS size",
]


def attempts(spark, sf):
    return table(spark, sf, "pages").selectExpr(*ATTEMPTS)


@query(f"""
WITH a AS (SELECT {", ".join(ATTEMPTS)} FROM pages), s AS (SELECT *, CASE WHEN file_there THEN 'Already Exists'
  WHEN http_error IS NOT NULL OR coalesce(http_status >= 400, false) THEN 'HTTP Error' WHEN failure IS NOT NULL THEN 'Error'
  WHEN coalesce(content_length > 52428800, false) THEN 'File Too Large'
  WHEN size < 1024 AND (contains(lower(left(content, 100)), '<html') OR contains(lower(left(content, 100)), 'error'))
    THEN 'Invalid Content' ELSE 'Success' END AS status FROM a)
SELECT page_id, status, CASE status
    WHEN 'Already Exists' THEN 'File already exists (' || format('{{:,}}', existing_size) || ' bytes)'
    WHEN 'HTTP Error' THEN 'HTTP request failed: ' || coalesce(http_error, 'status ' || http_status)
    WHEN 'Error' THEN 'Unexpected error: ' || failure
    WHEN 'File Too Large' THEN 'File too large: ' || format('{{:,}}', content_length) || ' bytes (max 50MB)'
    WHEN 'Invalid Content' THEN 'Downloaded file appears to be an error page, not a PDF'
    ELSE 'Downloaded successfully (' || format('{{:,}}', size) || ' bytes)' END AS status_message,
  CASE status WHEN 'Already Exists' THEN existing_size WHEN 'File Too Large' THEN content_length
    WHEN 'Invalid Content' THEN size WHEN 'Success' THEN size END AS file_size
FROM s
""")
def download_outcomes(spark, sf):
    """P15."""
    cols = ["file_there", "existing_size", "http_status", "http_error", "failure", "content_length", "content", "size"]
    return attempts(spark, sf).select("page_id", *download_outcome(*[F.col(c) for c in cols]))


PARSED = [
    "doc_id AS file_id", "source AS filename", "doc_id % 9 <> 0 AS there",
    "CAST(CASE WHEN doc_id % 9 = 1 THEN 52428801 ELSE 52428800 END AS BIGINT) AS file_size",
    "CASE WHEN doc_id % 9 = 2 THEN concat('  ', lang, '  ') WHEN doc_id % 9 = 3 THEN NULL ELSE text END AS body",
    "CASE WHEN doc_id % 9 = 4 THEN 'bad xref' END AS failure",
]


@query(f"""
WITH p AS (SELECT {", ".join(PARSED)} FROM documents), d AS (SELECT *, CASE WHEN NOT there THEN 'FILE_NOT_FOUND'
  WHEN file_size > 52428800 THEN 'FILE_TOO_LARGE' WHEN failure IS NOT NULL THEN 'EXTRACTION_ERROR'
  WHEN length(regexp_replace(coalesce(body, ''), '^\\s+|\\s+$', '', 'g')) < 10 THEN 'SUCCESS_LOW_CONTENT' ELSE 'SUCCESS' END AS detail FROM p)
SELECT file_id, detail AS detail_status, CASE detail WHEN 'SUCCESS' THEN 'SUCCESS' ELSE 'FAILED' END AS extraction_status,
  CASE detail WHEN 'SUCCESS' THEN length(body) ELSE 0 END::BIGINT AS character_count,
  md5(CASE detail WHEN 'SUCCESS' THEN body WHEN 'FILE_NOT_FOUND' THEN 'EXTRACTION FAILED: File not found: ' || filename
    WHEN 'FILE_TOO_LARGE' THEN 'EXTRACTION FAILED: File too large: 52,428,801 bytes (max 52,428,800 bytes)'
    WHEN 'EXTRACTION_ERROR' THEN 'EXTRACTION FAILED: Text extraction failed: bad xref'
    ELSE 'EXTRACTION FAILED: Extracted text too short (' || length(coalesce(body, '')) || ' chars)' END) AS text_md5
FROM d
""")
def extraction_outcomes(spark, sf):
    """P16."""
    rows = table(spark, sf, "documents").selectExpr(*PARSED)
    out = extraction_outcome(F.col("filename"), F.col("there"), F.col("file_size"), F.col("body"), F.col("failure"))
    return rows.select("file_id", *out).select(
        "file_id", "detail_status", "extraction_status", "character_count", F.md5("extracted_text").alias("text_md5")
    )


def _download_log(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("https://h/"), F.col("event_id").cast("string")).alias("attest_url"),
        F.concat(F.lit("f"), F.col("user_id").cast("string"), F.lit(".pdf")).alias("filename"),
        F.col("ts").alias("download_date"),
        F.when(F.col("event_type").isin("purchase", "view"), "Success")
        .when(F.col("event_type") == "click", "Already Exists").otherwise("HTTP Error").alias("status"),
        F.col("event_type").alias("status_message"),
        F.when(F.col("event_type") != "error", F.round(F.col("value") * 100000).cast("long")).alias("file_size"),
    )


LOG_SQL = """
WITH log AS (SELECT 'https://h/' || event_id AS attest_url, 'f' || user_id || '.pdf' AS filename, ts AS download_date,
  CASE WHEN event_type IN ('purchase', 'view') THEN 'Success' WHEN event_type = 'click' THEN 'Already Exists'
    ELSE 'HTTP Error' END AS status, event_type AS status_message,
  CASE WHEN event_type <> 'error' THEN CAST(round(value * 100000) AS BIGINT) END AS file_size FROM events)
"""


@query(LOG_SQL + "SELECT status, count(*) AS downloads, CAST(floor(avg(file_size)) AS BIGINT) AS avg_size FROM log GROUP BY 1")
def download_totals(spark, sf):
    """A4."""
    return R.download_stats(_download_log(spark, sf))


@query(LOG_SQL + """
SELECT CAST(download_date AS DATE) AS day, count(*) AS attempts, count(*) FILTER (status = 'Success') AS successful,
  count(*) FILTER (status <> 'Already Exists') AS not_skipped,
  CAST(CAST(count(*) FILTER (status = 'Success') * 100.0 / count(*) AS DECIMAL(5, 2)) AS DOUBLE) AS success_rate,
  CAST(CAST(count(*) FILTER (status = 'Success') * 100.0 / nullif(count(*) FILTER (status <> 'Already Exists'), 0) AS DECIMAL(5, 2)) AS DOUBLE) AS rate_without_skipped
FROM log GROUP BY 1
""")
def daily_success_rate(spark, sf):
    """A5."""
    out = R.daily_success(_download_log(spark, sf))
    return out.withColumns({c: F.col(c).cast("double") for c in ("success_rate", "rate_without_skipped")})


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS files_added FROM events GROUP BY 1")
def files_added_per_day(spark, sf):
    """A6."""
    return R.files_per_day(table(spark, sf, "events").withColumnRenamed("ts", "sync_date"))


@query("SELECT p_name AS filename, count(*) AS copies FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_file_names(spark, sf):
    """A7."""
    return R.duplicate_names(table(spark, sf, "part").withColumnRenamed("p_name", "filename"))


@query("""
SELECT CASE WHEN n_chars < 100 THEN 'FAILED' ELSE 'SUCCESS' END AS extraction_status, count(*) AS extracts,
  CAST(floor(avg(n_chars)) AS BIGINT) AS avg_chars, CAST(floor(avg(CASE WHEN lang <> 'de' THEN n_chars // 300 END)) AS BIGINT) AS avg_pages
FROM documents GROUP BY 1
""")
def extract_totals(spark, sf):
    """A3."""
    rows = table(spark, sf, "documents").select(
        F.when(F.col("n_chars") < 100, "FAILED").otherwise("SUCCESS").alias("extraction_status"),
        F.col("n_chars").alias("character_count"),
        F.when(F.col("lang") != "de", F.floor(F.col("n_chars") / 300)).alias("page_count"),
    )
    return R.extraction_stats(rows)


@query("""
SELECT count(*) AS total_records, count(l.doc_id) AS cleaned_records, count(*) FILTER (l.doc_id IS NULL) AS pending_records
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.toxic = 0
""")
def cleaning_progress(spark, sf):
    """A toxic label stands for a row whose text is null."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"))
    done = table(spark, sf, "labels").select(
        F.col("doc_id").alias("file_id"), F.when(F.col("toxic") == 0, "x").alias("clean_text")
    )
    return R.cleaning_coverage(docs, done)


ANSWER_EXPRS = [
    "conv_id * 1000 + turn AS file_id", "role AS PromptVersion",
    "CASE WHEN turn % 4 = 0 THEN '   ' WHEN turn % 4 = 1 THEN NULL ELSE text END AS AboutEstate",
    f"CASE WHEN turn % 3 = 0 THEN '{PLACEHOLDER}' ELSE concat(' ', text) END AS Positives",
    "text AS Evaluation",
    "conv_id", "turn",
]
ANSWERS_SQL = f"""
WITH answers AS (SELECT {", ".join(ANSWER_EXPRS)},
  TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(conv_id * 3 AS INTEGER)) + to_minutes(CAST(turn AS INTEGER)) AS Created FROM conversations)
"""


def _answers(spark, sf):
    rows = table(spark, sf, "conversations").selectExpr(*ANSWER_EXPRS)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    step = F.make_dt_interval(hours=(F.col("conv_id") * 3).cast("int"), mins=F.col("turn").cast("int"))
    return rows.withColumn("Created", start + step)


@query(ANSWERS_SQL + f"""
, f AS (SELECT *, length(trim(coalesce(AboutEstate, ''), ' ')) > 0 AS a, length(trim(Positives, ' ')) > 0 AS p,
  length(trim(Evaluation, ' ')) > 0 AS e FROM answers)
SELECT PromptVersion, count(*) AS total_responses, min(Created) AS first_processed, max(Created) AS last_processed,
  count(*) FILTER (a) AS has_about_estate, count(*) FILTER (p) AS has_positives, count(*) FILTER (e) AS has_evaluation,
  count(*) FILTER (a AND AboutEstate <> '{PLACEHOLDER}') AS real_about_estate,
  count(*) FILTER (p AND Positives <> '{PLACEHOLDER}') AS real_positives,
  count(*) FILTER (e AND Evaluation <> '{PLACEHOLDER}') AS real_evaluation,
  round(count(*) FILTER (a) * 100.0 / count(*), 4) AS pct_about_estate,
  round(count(*) FILTER (p) * 100.0 / count(*), 4) AS pct_positives,
  round(count(*) FILTER (e) * 100.0 / count(*), 4) AS pct_evaluation
FROM f GROUP BY 1
""")
def answer_completeness(spark, sf):
    """A2."""
    return R.answer_completeness(_answers(spark, sf))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_counts(spark, sf):
    """A13."""
    return row_counts({t: table(spark, sf, t) for t in TABLES})


_TYPES = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END"


@query(f"""
WITH n AS ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)})
SELECT c.table_name, c.column_name, CAST(ordinal_position AS INTEGER) AS position, {_TYPES} AS data_type, true AS nullable, row_count
FROM information_schema.columns c JOIN n ON n.table_name = c.table_name
""")
def table_dictionary(spark, sf):
    """S10."""
    return data_dictionary({t: table(spark, sf, t) for t in TABLES})


def _extracts(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("file_id"), F.col("source").alias("filename"), F.col("text").alias("extracted_text"),
        F.when(F.col("lang") == "de", "FAILED").otherwise("SUCCESS").alias("extraction_status"),
        F.length("text").cast("long").alias("character_count"), F.floor(F.col("n_chars") / 300).alias("page_count"),
        F.col("n_chars").alias("extraction_date"),
    )


@query("""
SELECT doc_id AS file_id, source AS filename, length(text)::BIGINT AS character_count, n_chars // 300 AS page_count,
  CASE lang WHEN 'de' THEN 'FAILED' ELSE 'SUCCESS' END AS extraction_status, n_chars AS extraction_date
FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10
""")
def topk_recent_extractions(spark, sf):
    """T1 (the size stands for the date)."""
    return R.recent_extractions(_extracts(spark, sf))


@query("""
SELECT doc_id AS file_id, source AS filename, length(text)::BIGINT AS character_count, left(text, 200) || '...' AS text_sample
FROM documents WHERE lang <> 'de' ORDER BY length(text) DESC, doc_id LIMIT 3
""")
def topk_longest_texts(spark, sf):
    """T2, P19."""
    return R.longest_texts(_extracts(spark, sf))


@query("""
SELECT o_orderkey AS file_id, o_orderpriority AS filename, CAST(round(o_totalprice * 1000) AS BIGINT) // 1048576 AS size_mb,
  o_orderdate AS sync_date FROM orders ORDER BY CAST(round(o_totalprice * 1000) AS BIGINT) DESC, o_orderkey LIMIT 10
""")
def topk_largest_files(spark, sf):
    """T3, P19."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("file_id"), F.col("o_orderpriority").alias("filename"),
        F.round(F.col("o_totalprice") * 1000).cast("long").alias("file_size"), F.col("o_orderdate").alias("sync_date"),
    )
    return R.largest_files(rows)


@query(LOG_SQL + """
SELECT filename, status, status_message, file_size // 1048576 AS size_mb, download_date
FROM log ORDER BY download_date DESC, attest_url LIMIT 20
""")
def topk_recent_downloads(spark, sf):
    """T4."""
    return R.recent_downloads(_download_log(spark, sf))


@query(ANSWERS_SQL + """
SELECT file_id, AboutEstate, Positives, Evaluation, Created FROM answers WHERE PromptVersion = 'assistant'
ORDER BY Created DESC, file_id LIMIT 5
""")
def topk_sample_answers(spark, sf):
    """T5."""
    return R.sample_answers(_answers(spark, sf), "assistant")


@query("""
SELECT d.doc_id AS file_id, source AS filename, n_chars AS extraction_date, quality AS cleaned_date,
  CAST(CASE WHEN quality = 1 THEN 4 ELSE 3 END * (l.doc_id IS NOT NULL)::INT AS INTEGER) AS raw_length
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY n_chars DESC, d.doc_id LIMIT 10
""")
def topk_recent_cleaning(spark, sf):
    """Quality stands for the cleaning date, its name for the text."""
    done = table(spark, sf, "labels").select(
        F.col("doc_id").alias("file_id"), F.col("quality").alias("cleaned_date"),
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("clean_text"),
    )
    out = R.recent_cleaning(_extracts(spark, sf), done)
    return out.select("file_id", "filename", "extraction_date", "cleaned_date", F.coalesce("cleaned_length", F.lit(0)).alias("raw_length"))


VIEW_SQL = ANSWERS_SQL + f"""
, bi AS (SELECT file_id, PromptVersion, trim(AboutEstate, ' ') AS AboutEstate, trim(Positives, ' ') AS Positives,
  trim(Evaluation, ' ') AS Evaluation, length(trim(Evaluation, ' ')) AS EvaluationLength, Created AS ProcessedDate
  FROM answers WHERE length(trim(AboutEstate, ' ')) > 0 AND length(trim(Positives, ' ')) > 0 AND length(trim(Evaluation, ' ')) > 0
  AND trim(AboutEstate, ' ') <> '{PLACEHOLDER}' AND trim(Positives, ' ') <> '{PLACEHOLDER}' AND trim(Evaluation, ' ') <> '{PLACEHOLDER}')
"""


@query(VIEW_SQL + "SELECT * REPLACE (CAST(EvaluationLength AS INTEGER) AS EvaluationLength) FROM bi")
def answers_bi_view(spark, sf):
    """S11."""
    return R.answers_view(_answers(spark, sf))


@query(VIEW_SQL + """SELECT date_trunc('month', ProcessedDate) AS "month", PromptVersion, count(*) AS answers,
CAST(floor(avg(EvaluationLength)) AS BIGINT) AS avg_evaluation_chars FROM bi GROUP BY 1, 2""")
def answers_by_month(spark, sf):
    """A16."""
    out = R.answer_trend(R.answers_view(_answers(spark, sf)))
    return out.withColumn("month", F.col("month").cast("timestamp_ntz"))


@query(VIEW_SQL + """SELECT file_id, PromptVersion, ProcessedDate FROM bi
WHERE ProcessedDate >= TIMESTAMP '2024-04-05 00:00:00' - INTERVAL 3 MONTH ORDER BY ProcessedDate DESC, file_id LIMIT 100""")
def topk_last_months(spark, sf):
    """T7."""
    as_of = F.lit("2024-04-05 00:00:00").cast("timestamp_ntz")
    return R.last_months(R.answers_view(_answers(spark, sf)), as_of).select("file_id", "PromptVersion", "ProcessedDate")


@query(f"""
SELECT rating, RatingName, SortOrder, certificates FROM (
  SELECT substr('ABCDEFGHIJ', p_size % 10 + 1, 1) AS rating, count(*) AS certificates FROM part GROUP BY 1)
LEFT JOIN (VALUES {", ".join(str(r) for r in RATINGS)}) r(RatingCode, RatingName, d, SortOrder) ON RatingCode = rating
""")
def rating_counts(spark, sf):
    """A16, J11."""
    rows = table(spark, sf, "part").selectExpr("substr('ABCDEFGHIJ', p_size % 10 + 1, 1) AS rating")
    return R.rating_distribution(rows, ratings(spark), "rating")


@query(LOG_SQL + """
SELECT 'download' AS stage, count(*) AS processed, count(*) FILTER (status = 'Success') AS successful,
  count(*) FILTER (status <> 'Success') AS failed, round(count(*) FILTER (status = 'Success') * 100.0 / count(*), 4) AS success_pct
FROM log
""")
def stage_totals(spark, sf):
    """A11."""
    return R.stage_report(_download_log(spark, sf), "download", F.col("status") == "Success")
