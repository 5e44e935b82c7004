"""Parts of operators beside their main form: S3, S9, S10, F2, F3, U1, L5, A1, A9, A11, A12, A13, C4-C6, S5."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from certflow.functions import text as X
from certflow.functions.answers import SECTIONS
from certflow.functions.scalars import file_name_from_url
from certflow.operators.lifecycle import append_new
from certflow.operators.procedures import register_procedures
from certflow.operators.quantiles import ERROR, merged, quantiles, sketch
from certflow.operators.reconcile import missing, shared
from certflow.operators.reports import directory_stats, sample_files, stage_report, status_breakdown
from certflow.operators.responses import unknown_fields
from certflow.plans import jobs
from certflow.plans.queries.imports import LANDED_ORDERS, _landed_orders
from certflow.plans.queries.joins import CALLS, URL_NAME_SQL
from certflow.plans.queries.landing import land_customers
from certflow.plans.queries.lifecycle import _event_log, order_calls
from certflow.plans.queries.registry import SQL, query, table
from certflow.plans.queries.texts import MIXED_TEXT, _clean_sql, _nfkd_sql, _strip
from certflow.schemas import ANSWERS, CLEANED_TEXT
from certflow.session import scratch_dir
from certflow.sources.catalog import catalog_columns, catalog_objects, dictionary_json, dictionary_report, missing_names, with_row_counts
from certflow.sources.landing import dialects_of, land_chunks, mark_latest, sample_records, scan_chunks
from certflow.sources.tables import append_batch, read_batches

WHEN = datetime(2025, 1, 2, 3, 4, 5)


@query("""
SELECT 'A' || c_custkey AS Attestnummer, CAST(c_nationkey AS VARCHAR) AS Knr, CAST(position AS INTEGER) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey % 3 ORDER BY c_custkey % 10 = 3, c_custkey) AS position FROM customer) WHERE position <= 3
""")
def csv_samples(spark, sf):
    """S3: the first three records of each landed file."""
    root = scratch_dir(spark, "samples")
    chunks = land_chunks(spark, land_customers(spark, sf, root), f"{root}/chunks", (2023, 2023))
    return sample_records(scan_chunks(chunks, dialects_of(chunks)), 3).select("Attestnummer", "Knr", "position")


@query(f"""
SELECT full_path, "year", full_path = first_value(full_path) OVER (PARTITION BY "year" ORDER BY modified DESC, full_path DESC) AS is_latest
FROM ({LANDED_ORDERS})
""")
def latest_marked(spark, sf):
    """All files of a year, and which one is the newest."""
    return mark_latest(_landed_orders(spark, sf), F.col("year")).select("full_path", "year", "is_latest")


def _files(spark, sf):
    name = F.concat(F.col("doc_id").cast("string"), F.lit("."), "lang")
    return table(spark, sf, "documents").select(
        name.alias("filename"), F.concat(F.lit("/files/"), name).alias("full_path"), F.col("n_chars").alias("file_size"),
        F.concat(F.lit("."), "lang").alias("file_extension"))


@query("""
SELECT '.' || lang AS file_extension, count(*) AS files, sum(n_chars)::BIGINT AS bytes, round(sum(n_chars) / 1024.0 / 1024.0, 1) AS mb FROM documents GROUP BY lang
UNION ALL SELECT NULL, count(*), sum(n_chars)::BIGINT, round(sum(n_chars) / 1024.0 / 1024.0, 1) FROM documents
""")
def directory_files(spark, sf):
    """A9 with the number of files: documents stand for files, their language for the suffix."""
    return directory_stats(_files(spark, sf))


@query("SELECT doc_id || '.fr' AS filename, round(n_chars / 1024.0 / 1024.0, 1) AS mb FROM documents WHERE lang = 'fr' ORDER BY filename LIMIT 5")
def directory_samples(spark, sf):
    """The first files of a suffix."""
    return sample_files(_files(spark, sf), ".fr")


@query("""
SELECT 'parts' AS stage, count(*) AS processed, count(*) FILTER (p_size <= 25) AS successful, count(*) FILTER (p_size > 25) AS failed,
  round(count(*) FILTER (p_size <= 25) / count(*) * 100.0, 4) AS success_pct, CAST(12.5 AS DOUBLE) AS seconds, round(count(*) / 12.5, 4) AS rows_per_second
FROM part
""")
def stage_rates(spark, sf):
    """A11 with the seconds that a stage took and its rate."""
    return stage_report(table(spark, sf, "part"), "parts", F.col("p_size") <= 25, 12.5)


@query(f"""
SELECT doc_id, md5(array_to_string(list_filter(string_split(text, chr(10)),
  lambda x: {_strip('x')} = '' OR NOT regexp_matches({_strip('x')}, '^(?i:all rights|[a-f]{{2,}}\\w* )')), chr(10))) AS text_md5
FROM documents
""")
def own_patterns(spark, sf):
    """lines that begin with one of a caller's patterns go."""
    kept = X.drop_lines_matching(F.col("text"), ["all rights", r"[a-f]{2,}[A-Za-z0-9_]* "])
    return table(spark, sf, "documents").select("doc_id", F.md5(kept).alias("text_md5"))


@query("""
SELECT 'missing' AS kind, 'C' || c_custkey AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'shared', 'C' || c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
""")
def customer_sets(spark, sf):
    """Names of all customers against those of all orders, which lack some."""
    name = lambda c: F.concat(F.lit("C"), F.col(c).cast("string")).alias("name")
    customers, ordering = table(spark, sf, "customer").select(name("c_custkey")), table(spark, sf, "orders").select(name("o_custkey"))
    kind = lambda rows, k: rows.select(F.lit(k).alias("kind"), "name")
    return kind(missing(customers, ordering, "name"), "missing").unionByName(kind(shared(customers, ordering, "name"), "shared"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def appended_rows(spark, sf):
    """The customers that an append to the ordering ones adds."""
    stored = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return append_new(stored, table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), ["c_custkey"])[0]


@query("""
WITH b AS (SELECT * FROM events WHERE ts = (SELECT max(ts) FROM events WHERE event_type = 'purchase'))
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'Pending' ELSE event_type END AS status_message, count(*) AS calls,
  CAST(sum(coalesce(CASE WHEN event_type <> 'error' THEN CAST(round(value) AS BIGINT) END, 0)) AS BIGINT) AS records
FROM b GROUP BY ROLLUP (1)
""")
def status_of_batch(spark, sf):
    """A1 of one batch: the calls that share the time of the last purchase."""
    log = _event_log(spark, sf)
    last = table(spark, sf, "events").where("event_type = 'purchase'").agg(F.max("ts").alias("t"))
    rows = log.join(last, F.col("LogDate") == F.col("t"))
    return status_breakdown(rows, F.col("t"))


SHARES = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query(f"""
WITH r AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) AS i, count(*) OVER (PARTITION BY source) AS n FROM documents),
p AS (SELECT unnest({SHARES}::DOUBLE[]) AS share)
SELECT source, share, min(n_chars) FILTER (i >= ceil(share * n)) AS exact, true AS within, true AS merged_is_whole
FROM r, p GROUP BY source, share
""")
def percentile_sketches(spark, sf):
    """Percentiles of text lengths by source, from sketches stored in five batches and added up, beside the exact ones."""
    root, docs = scratch_dir(spark, "sketches"), table(spark, sf, "documents").select("source", "n_chars", (F.col("doc_id") % 5).alias("batch"))
    for k in range(5):
        one = append_batch(sketch(docs.where(F.col("batch") == k), ["source"], "n_chars"), root, "lengths", f"b{k}")
    stored = read_batches(spark, root, "lengths", one.schema)
    whole = quantiles(sketch(docs, ["source"], "n_chars"), ["source"], SHARES).withColumnRenamed("estimate", "at_once")
    found = quantiles(merged(stored, ["source"]), ["source"], SHARES).join(whole, ["source", "share"])
    lists = docs.groupBy("source").agg(*[F.expr(f"percentile_disc({s}) WITHIN GROUP (ORDER BY n_chars)").alias(f"p{k}") for k, s in enumerate(SHARES)])
    exact = lists.select("source", F.posexplode(F.array(*[F.col(f"p{k}") for k in range(len(SHARES))])).alias("k", "exact")).select(
        "source", F.element_at(F.array(*[F.lit(s) for s in SHARES]), F.col("k") + 1).alias("share"), F.col("exact").cast("long").alias("exact"))
    return found.join(exact, ["source", "share"]).select(
        "source", "share", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * (ERROR + 1e-9)).alias("within"),
        (F.col("estimate") == F.col("at_once")).alias("merged_is_whole"))


@query(f"""
SELECT * FROM (SELECT 'api' AS list, CAST(c_custkey AS VARCHAR) AS key FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ORDER BY c_custkey LIMIT 20)
UNION ALL SELECT 'api all', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION ALL SELECT * FROM (SELECT DISTINCT 'url', url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE length(html) > 2000)
  AND {URL_NAME_SQL} NOT IN (SELECT {URL_NAME_SQL} FROM pages WHERE length(html) < 500) ORDER BY url LIMIT 30)
UNION ALL SELECT 'extract', file_id FROM (SELECT CAST(doc_id AS VARCHAR) AS file_id FROM documents
  WHERE lang <> 'en' AND doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY source || '/' || doc_id || '.pdf', doc_id LIMIT 40)
UNION ALL SELECT 'clean', file_id FROM (SELECT doc_id || ':' || length(text) AS file_id FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 50)
""")
def sql_worklists(spark, sf):
    """the four worklists called from SQL, by their number of rows, and one without a limit."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    pages = table(spark, sf, "pages").select(F.col("url").alias("attest_url"), F.length("html").alias("size"))
    pages = pages.withColumn("expected_filename", file_name_from_url(F.col("attest_url")))
    done = labels.select(F.col("doc_id").alias("file_id"))
    files = docs.select(F.col("doc_id").alias("file_id"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"),
                        F.lit("/").alias("full_path"), F.col("n_chars").alias("file_size"), F.when(F.col("lang") == "en", ".txt").otherwise(".PDF").alias("file_extension"))
    register_procedures(spark, {
        "certificates": table(spark, sf, "customer").selectExpr(*CALLS),
        "api_log": table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("CertificateID")),
        "urls": pages.drop("size"),
        "download_log": pages.select("attest_url", F.when(F.col("size") > 2000, "Success").otherwise("HTTP Error").alias("status")),
        "inventory": pages.where("size < 500").select(F.col("expected_filename").alias("filename"), F.lit(None).cast("bigint").alias("file_id"),
                                                      F.lit("/").alias("full_path"), F.lit(0).cast("bigint").alias("file_size"), F.lit("").alias("file_extension"))
        .unionByName(files),
        "extracts": done.select("file_id", F.lit("").alias("extracted_text")),
        "cleaned": done,
    })
    lists = spark.sql("""
        SELECT 'api' AS list, CAST(CertificateID AS STRING) AS key FROM api_worklist(20)
        UNION ALL SELECT 'api all', CAST(CertificateID AS STRING) FROM api_worklist()
        UNION ALL SELECT 'url', attest_url FROM url_worklist(30)
        UNION ALL SELECT 'extract', CAST(file_id AS STRING) FROM extract_worklist(top_rows => 40)""")
    # the texts left to clean are another table of extracts than the one of files left to extract
    register_procedures(spark, {"extracts": docs.select(F.col("doc_id").alias("file_id"), F.col("text").alias("extracted_text")), "cleaned": done})
    return lists.unionByName(spark.sql("SELECT 'clean' AS list, file_id || ':' || length(extracted_text) AS key FROM clean_worklist(50)"))


@query(f"""
SELECT CAST(doc_id AS VARCHAR) AS file_id, md5(c) AS clean_md5, length(c) AS character_count FROM (
  SELECT doc_id, text AS t, {_clean_sql(_nfkd_sql('text'))} AS c FROM documents) WHERE length({_strip('t')}) >= 10 AND length(c) >= 5
""")
def job_cleaned(spark, sf):
    """C4: the cleaned texts as stored, after the same batch ran twice and a second batch found nothing."""
    root = scratch_dir(spark, "job-cleaned")
    extracts = table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), F.col("text").alias("extracted_text"))
    for batch in ("b1", "b1", "b2"):
        jobs.clean_texts(extracts, root, batch, WHEN)
    return read_batches(spark, root, "cleaned", CLEANED_TEXT).select("file_id", F.md5("clean_text").alias("clean_md5"), "character_count")


@query(f"SELECT CAST(doc_id AS VARCHAR) AS file_id, 'V1' AS PromptVersion, {', '.join(SECTIONS)} FROM ({SQL['answers_parsed']})")
def job_answers(spark, sf):
    """The answers as stored, after the same batch ran twice."""
    root, docs = scratch_dir(spark, "job-answers"), table(spark, sf, "documents")
    prompts = docs.select(F.col("doc_id").alias("FILE_ID"), F.lit("ask").alias("V1"))
    replies = docs.select(F.col("doc_id").alias("file_id"), F.lit("V1").alias("prompt_version"), F.expr(MIXED_TEXT).alias("response_text"))
    for _ in range(2):
        jobs.parse_answers(prompts, replies, root, "b1", WHEN, "V1")
    return read_batches(spark, root, "answers", ANSWERS).select("file_id", "PromptVersion", *SECTIONS)


@query(f"""
WITH c AS (SELECT text AS t, {_clean_sql(_nfkd_sql('text'))} AS c FROM documents),
n AS (SELECT count(*) AS processed, count(*) FILTER (length({_strip('t')}) >= 10 AND length(c) >= 5) AS successful FROM c)
SELECT 'clean' AS stage, true AS success, CAST(NULL AS VARCHAR) AS error, processed, successful, processed - successful AS failed FROM n
UNION ALL SELECT 'broken', false, 'stops after ' || processed || ' texts', NULL, NULL, NULL FROM n
UNION ALL SELECT 'answer', true, NULL, processed, processed, 0 FROM n
""")
def job_reports(spark, sf):
    """The reports that a run of stages stores, one of which fails and stops no other."""
    root, docs = scratch_dir(spark, "job-reports"), table(spark, sf, "documents")
    extracts = docs.select(F.col("doc_id").alias("file_id"), F.col("text").alias("extracted_text"))
    prompts = docs.select(F.col("doc_id").alias("FILE_ID"), F.lit("ask").alias("V1"))
    replies = docs.select(F.col("doc_id").alias("file_id"), F.lit("V1").alias("prompt_version"), F.col("text").alias("response_text"))

    def broken():
        raise RuntimeError(f"stops after {docs.count()} texts")

    run = jobs.run_stages(spark, {
        "clean": lambda: jobs.clean_texts(extracts, root, "b1", WHEN), "broken": broken,
        "answer": lambda: jobs.parse_answers(prompts, replies, root, "b1", WHEN, "V1"),
    }, root, "b1")
    places = [r.report for r in run.collect() if r.report]
    reports = spark.read.parquet(*places).select("stage", "processed", "successful", "failed")
    return run.select("stage", "success", "error").join(reports, "stage", "left")


@query("""
SELECT o_orderkey AS CertificateID, path, value FROM orders JOIN customer ON o_custkey = c_custkey,
  (VALUES (0, 'energiattest.versjon'), (1, 'kilde'), (2, 'enhet.bygg.etasjer')) p(k, path),
  LATERAL (SELECT CASE k WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN '{"navn":"' || c_mktsegment || '"}' ELSE '[1,2]' END AS value)
WHERE o_orderkey % 10 <> 9 AND o_orderkey % 5 = k
""")
def response_unknown(spark, sf):
    """Fields of landed bodies that no column takes, at any level, from one parse."""
    key = F.col("CertificateID")
    body = (F.when(key % 5 == 0, F.regexp_replace("body", r'^(\[\{.*?"energiattest":\{)', F.concat(F.lit('$1"versjon":'), key.cast("string"), F.lit(","))))
            .when(key % 5 == 1, F.regexp_replace("body", r"^(\[\{)", F.concat(F.lit('$1"kilde":{"navn":"'), F.col("segment"), F.lit('"},'))))
            .when(key % 5 == 2, F.regexp_replace("body", r'^(.*?"bygg":\{)', F.lit('$1"etasjer":[1,2],'))).otherwise(F.col("body")))
    segment = table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("o_orderkey").alias("CertificateID"), F.col("c_mktsegment").alias("segment"))
    calls = order_calls(spark, sf).join(segment, "CertificateID").withColumn("body", body)
    return unknown_fields(calls).select("CertificateID", "path", "value")


def _catalog(spark, sf) -> str:
    """A schema with two tables that hold the nations and the customers of the given tables; gives its name."""
    place = scratch_dir(spark, "catalog")
    name = f"dictionary_{place.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    spark.sql(f"""CREATE TABLE {name}.certificate (Attestnummer VARCHAR(50) COMMENT 'key of the certificate', Karakter CHAR(1) DEFAULT 'G',
        Areal DECIMAL(10,2), Versjon INT DEFAULT 1) USING parquet COMMENT 'certificates as imported'""")
    spark.sql(f"CREATE TABLE {name}.place (Knr BIGINT COMMENT 'number', Navn VARCHAR(25)) USING parquet")
    spark.sql(f"CREATE VIEW {name}.places_view AS SELECT Navn FROM {name}.place")
    spark.sql(f"CREATE FUNCTION {name}.twice(x BIGINT) RETURNS BIGINT RETURN x * 2")
    table(spark, sf, "customer").select(
        F.col("c_name").alias("Attestnummer"), F.lit("A").alias("Karakter"), F.lit(None).cast("decimal(10,2)").alias("Areal"), F.lit(2).alias("Versjon")
    ).write.insertInto(f"{name}.certificate")
    table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS Knr", "left(n_name, 25) AS Navn").write.insertInto(f"{name}.place")
    return name


_DICTIONARY = """
WITH n AS (SELECT 'certificate' AS t, count(*) AS row_count FROM customer UNION ALL SELECT 'place', count(*) FROM nation)
SELECT table_name, column_name, CAST(position AS INTEGER) AS position, data_type, CAST(max_length AS INTEGER) AS max_length, CAST(prec AS INTEGER) AS "precision",
  CAST(scale AS INTEGER) AS scale, default_value, description, table_comment, row_count
FROM (VALUES ('certificate', 'Attestnummer', 1, 'varchar(50)', 50, NULL, NULL, NULL, 'key of the certificate', 'certificates as imported'),
  ('certificate', 'Karakter', 2, 'char(1)', 1, NULL, NULL, '''G''', NULL, 'certificates as imported'),
  ('certificate', 'Areal', 3, 'decimal(10,2)', NULL, 10, 2, NULL, NULL, 'certificates as imported'),
  ('certificate', 'Versjon', 4, 'int', NULL, NULL, NULL, '1', NULL, 'certificates as imported'),
  ('place', 'Knr', 1, 'bigint', NULL, NULL, NULL, NULL, 'number', NULL), ('place', 'Navn', 2, 'varchar(25)', 25, NULL, NULL, NULL, NULL, NULL))
  d(table_name, column_name, position, data_type, max_length, prec, scale, default_value, description, table_comment) JOIN n ON t = table_name
"""


@query(_DICTIONARY)
def catalog_dictionary(spark, sf):
    """Columns of a catalog's tables with lengths, defaults and descriptions, and the rows of each table."""
    found = with_row_counts(spark, catalog_columns(spark, [_catalog(spark, sf)]))
    return found.select("table_name", "column_name", "position", "data_type", "max_length", "precision", "scale", "default_value", "description", "table_comment", "row_count")


@query("""
WITH c AS (SELECT count(*) AS n FROM customer), p AS (SELECT count(*) AS n FROM nation)
SELECT 'json' AS kind, '{"schema":"S","name":"place","description":null,"row_count":' || p.n || ',"columns":[{"column_name":"Knr","data_type":"bigint","max_length":null,'
  || '"precision":null,"scale":null,"nullable":true,"default_value":null,"description":"number"},{"column_name":"Navn","data_type":"varchar(25)","max_length":25,'
  || '"precision":null,"scale":null,"nullable":true,"default_value":null,"description":null}]}' AS value FROM p
UNION ALL SELECT 'markdown', '### S.certificate' || chr(10) || 'certificates as imported' || chr(10) || chr(10) || '**Rows**: ' || c.n || chr(10) || chr(10)
  || '| Column | Type | Length | Nullable | Default | Description |' || chr(10) || '|---|---|---|---|---|---|' FROM c
UNION ALL SELECT 'markdown', line FROM (VALUES ('| Attestnummer | varchar(50) | 50 | Yes |  | key of the certificate |'), ('| Karakter | char(1) | 1 | Yes | ''G'' |  |'),
  ('| Areal | decimal(10,2) |  | Yes |  |  |'), ('| Versjon | int |  | Yes | 1 |  |')) l(line)
UNION ALL SELECT 'tables', '2 1 1'
UNION ALL SELECT 'missing', 'S.answers'
UNION ALL SELECT 'missing', 'no_such_schema'
""")
def catalog_documents(spark, sf):
    """The dictionary as JSON and Markdown, the objects of the schema, and required names that are not there."""
    name = _catalog(spark, sf)
    found = with_row_counts(spark, catalog_columns(spark, [name]))
    row = lambda df, kind, value: df.select(F.lit(kind).alias("kind"), F.replace(value, F.lit(name), F.lit("S")).alias("value"))
    lacking = missing_names(spark, {name: ["Certificate", "place", "answers"], "no_such_schema": ["x"]})
    return (row(dictionary_json(found).where("table_name = 'place'"), "json", F.col("document"))
            .unionByName(row(dictionary_report(found).where("table_name = 'certificate'"), "markdown", F.col("value")))
            .unionByName(row(catalog_objects(spark, [name]), "tables", F.concat_ws(" ", "tables", "views", "functions")))
            .unionByName(row(lacking, "missing", F.concat_ws(".", "schema_name", "table_name"))))
