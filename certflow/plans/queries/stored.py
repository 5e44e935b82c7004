"""What the jobs store, read back after the same batch ran twice."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from certflow.plans import jobs
from certflow.plans.queries.imports import land_orders
from certflow.plans.queries.lifecycle import order_calls
from certflow.plans.queries.registry import query, table
from certflow.schemas import API_LOG, CALL_COLUMNS, FILE_EXTRACT, FILE_INVENTORY, IMPORTED
from certflow.session import scratch_dir
from certflow.sources.tables import read_batches, read_version

WHEN = datetime(2025, 1, 2, 3, 4, 5)
RUNS = range(2)


@query("""
SELECT CAST(o_custkey AS DOUBLE) AS Knr, CAST(o_totalprice AS VARCHAR) AS BeregnetFossilandel,
  'Åsveien; nr ' || o_orderkey || ', "A"' AS GateAdresse, date_trunc('second', o_orderdate) AS Utstedelsesdato,
  'Energiattest-' || o_orderkey AS Attestnummer
FROM orders
""")
def job_imported(spark, sf):
    """The certificate rows of an import."""
    root, landed = scratch_dir(spark, "job-import"), land_orders(spark, sf)
    for _ in RUNS:
        jobs.import_certificates(spark, landed, root, "b1")
    rows = read_batches(spark, root, "imported", IMPORTED)
    return rows.select("Knr", "BeregnetFossilandel", "GateAdresse",
                       F.col("Utstedelsesdato").cast("timestamp_ntz").alias("Utstedelsesdato"), "Attestnummer")


@query("""
SELECT o_orderkey AS CertificateID, 'EA-' || o_orderkey AS Attestnummer,
  CASE WHEN o_orderkey % 10 = 9 THEN 0 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS records_returned,
  CASE WHEN o_orderkey % 10 = 9 THEN 'No records found' ELSE 'Success' END AS status_message
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 <> 0
UNION ALL SELECT o_orderkey, 'EA-' || o_orderkey, NULL, 'Pending' FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 = 0
""")
def job_calls(spark, sf):
    """The call log and the calls that still wait, as a seventh has no answer yet."""
    root, calls = scratch_dir(spark, "job-calls"), order_calls(spark, sf)
    landed = calls.where("CertificateID % 7 <> 0").select("CertificateID", "http_status", "body")
    for _ in RUNS:
        jobs.process_responses(calls.select(*CALL_COLUMNS), landed, root, "b1", WHEN)
    rows = read_batches(spark, root, "api_log", API_LOG).unionByName(read_version(spark, root, "api_pending", API_LOG))
    return rows.select("CertificateID", "Attestnummer", F.when(F.col("status_message") != "Pending", F.col("records_returned")).alias("records_returned"), "status_message")


def _listing(spark, sf):
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".pdf"))
    return table(spark, sf, "documents").select(
        name.alias("filename"), F.concat(F.lit("/pdf/"), name).alias("full_path"), F.col("n_chars").alias("file_size"),
        F.lit(".pdf").alias("file_extension"), "text")


@query("""
SELECT sha256('/pdf/' || doc_id || '.pdf') AS file_id, doc_id || '.pdf' AS filename, '/pdf/' || doc_id || '.pdf' AS full_path, n_chars AS file_size
FROM documents
""")
def job_inventory(spark, sf):
    """The inventory after a scan and a forced scan of the same files."""
    root, listing = scratch_dir(spark, "job-inventory"), _listing(spark, sf).drop("text")
    jobs.sync_inventory(listing, root, WHEN)
    jobs.sync_inventory(listing, root, WHEN.replace(hour=4), skip_existing=False)
    return read_version(spark, root, "inventory", FILE_INVENTORY).select("file_id", "filename", "full_path", "file_size")


@query("""
WITH d AS (SELECT *, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 10 AS short FROM documents)
SELECT sha256('/pdf/' || doc_id || '.pdf') AS file_id, CASE WHEN short THEN 'FAILED' ELSE 'SUCCESS' END AS extraction_status,
  CASE WHEN short THEN 0 ELSE length(text) END::BIGINT AS character_count,
  md5(CASE WHEN short THEN 'EXTRACTION FAILED: Extracted text too short (' || length(text) || ' chars)' ELSE text END) AS text_md5
FROM d
""")
def job_extracts(spark, sf):
    """The extracts of all files of the inventory."""
    root, files = scratch_dir(spark, "job-extracts"), _listing(spark, sf)
    jobs.sync_inventory(files.drop("text"), root, WHEN)
    parsed = files.select("full_path", F.lit(True).alias("exists"), "text", F.lit(None).cast("string").alias("error"), F.lit(1).alias("page_count"))
    for _ in RUNS:
        jobs.record_extracts(parsed, root, "b1", WHEN)
    return read_batches(spark, root, "extracts", FILE_EXTRACT).select(
        "file_id", "extraction_status", "character_count", F.md5("extracted_text").alias("text_md5"))
