"""CSV import: S1-S4, P1-P7, W1, J1, L5, A10, A14, A15, J12, W2, X20, S8, S9."""

from __future__ import annotations

from pyspark.sql import functions as F

from certflow.functions.scalars import landed_name
from certflow.operators.conform import conform, keep_first, keep_latest
from certflow.operators.lifecycle import append_new, merge
from certflow.operators.reports import import_summary, landing_summary, year_summary
from certflow.operators.spread import tasks_for
from certflow.operators.worklists import new_records
from certflow.plans.queries.registry import query, table
from certflow.session import scratch_dir
from certflow.sources.landing import landed_files, latest_per_year, probe, profile, scan
from certflow.sources.tables import append_batch

# Input of the conform query: customers spelled as dirty text, read alike by both engines.
DIRTY_CUSTOMERS = [
    """CASE WHEN c_custkey % 11 = 0 THEN 'NA' WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 6 = 1 THEN '12a'
       WHEN c_custkey % 6 = 2 THEN '12d' WHEN c_custkey % 6 = 3 THEN ' 1987 '
       ELSE cast(c_nationkey AS string) END AS Knr""",
    "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE cast(c_acctbal AS string) END AS Byggear",
    """CASE WHEN c_custkey % 11 = 0 THEN 'null' WHEN c_custkey % 4 = 0 THEN 'xx'
       WHEN c_custkey % 4 = 1 THEN concat('2025-', lpad(cast(c_custkey % 12 + 1 AS string), 2, '0'), '-15T00:00:00')
       WHEN c_custkey % 4 = 2 THEN concat('15.', lpad(cast(c_custkey % 12 + 1 AS string), 2, '0'), '.2024')
       ELSE NULL END AS Utstedelsesdato""",
    """CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 5 = 0 THEN '   ' WHEN c_custkey % 5 = 1 THEN ' nan '
       ELSE concat('  ', c_mktsegment, ' ') END AS GateAdresse""",
    "CASE WHEN c_custkey % 11 = 0 THEN 'N/A' ELSE c_name END AS Attestnummer",
    """CASE WHEN c_custkey % 11 = 0 THEN '#N/A' ELSE concat(cast(c_custkey % 100 AS string), ',5') END
       AS BeregnetFossilandel""",
    """CASE WHEN c_custkey % 11 = 0 THEN 'NaN' WHEN c_custkey % 3 = 0 THEN 'True' WHEN c_custkey % 3 = 1 THEN 'False'
       ELSE 'Ja' END AS HarEnergiVurdering""",
    "'x' AS Ukjent",
]


@query(f"""
WITH raw AS (SELECT {", ".join(DIRTY_CUSTOMERS)} FROM customer),
typed AS (
  SELECT
    CASE WHEN regexp_full_match(trim(Knr), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
      THEN try_cast(trim(Knr) AS DOUBLE) END AS Knr,
    try_cast(trim(Byggear) AS DOUBLE) AS Byggear,
    coalesce(try_strptime(trim(Utstedelsesdato), '%Y-%m-%dT%H:%M:%S'),
             try_strptime(trim(Utstedelsesdato), '%d.%m.%Y')) AS Utstedelsesdato,
    CASE WHEN GateAdresse <> '' AND trim(GateAdresse) <> 'nan' THEN trim(GateAdresse) END AS GateAdresse,
    nullif(Attestnummer, 'N/A') AS Attestnummer,
    replace(nullif(BeregnetFossilandel, '#N/A'), ',', '.') AS BeregnetFossilandel,
    CASE WHEN HarEnergiVurdering IN ('True', 'False') THEN HarEnergiVurdering END AS HarEnergiVurdering
  FROM raw)
SELECT * FROM typed
WHERE NOT (Knr IS NULL AND Byggear IS NULL AND Utstedelsesdato IS NULL AND GateAdresse IS NULL
  AND Attestnummer IS NULL AND BeregnetFossilandel IS NULL AND HarEnergiVurdering IS NULL)
""")
def csv_conform(spark, sf):
    out = conform(table(spark, sf, "customer").selectExpr(*DIRTY_CUSTOMERS))
    return out.withColumn("Utstedelsesdato", F.col("Utstedelsesdato").cast("timestamp_ntz"))


def land_orders(spark, sf, where: str = "true", root: str | None = None) -> str:
    """Write the orders as yearly CSV folders in two dialects, beside what is there; returns the folder."""
    root = root or scratch_dir(spark, "landing")
    orders = table(spark, sf, "orders").where(where).select(
        F.col("o_custkey").cast("string").alias("Knr"),
        F.col("o_totalprice").cast("string").alias("BeregnetFossilandel"),
        F.concat(F.lit("Åsveien; nr "), F.col("o_orderkey").cast("string"), F.lit(', "A"')).alias("GateAdresse"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("Utstedelsesdato"),
        F.concat(F.lit("Energiattest-"), F.col("o_orderkey").cast("string")).alias("Attestnummer"),
        F.col("o_orderpriority").alias("Prioritet"),
        F.concat(F.lit("enova_data_"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("landed"),
        (F.col("o_orderstatus") == "F").alias("latin"),
    )
    writer = {"UTF-8": ("NOT latin", ","), "ISO-8859-1": ("latin", ";")}
    for encoding, (rows, sep) in writer.items():
        (
            orders.filter(rows).drop("latin").write.mode("append").partitionBy("landed")
            .options(header=True, sep=sep, encoding=encoding, escape='"').csv(f"{root}/{encoding}")
        )
    return root


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS "year",
  CASE WHEN o_orderstatus = 'F' THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding,
  CASE WHEN o_orderstatus = 'F' THEN ';' ELSE ',' END AS separator,
  6 AS n_columns, count(*) AS total_rows
FROM orders GROUP BY 1, 2, 3
""")
def csv_profile(spark, sf):
    """Files of both dialects found again, rows counted per year and dialect."""
    root = land_orders(spark, sf)
    # the probe reads all files, so its result is stored before it is used twice
    dialects = append_batch(probe(spark, root), scratch_dir(spark, "probe"), "dialects", "b1")
    files = profile(dialects, scan(spark, dialects))
    return files.groupBy("year", "encoding", "separator", "n_columns").agg(F.sum("total_rows").alias("total_rows"))


@query("""
SELECT CAST(o_custkey AS DOUBLE) AS Knr, CAST(o_totalprice AS VARCHAR) AS BeregnetFossilandel,
  'Åsveien; nr ' || o_orderkey || ', "A"' AS GateAdresse, date_trunc('second', o_orderdate) AS Utstedelsesdato,
  'Energiattest-' || o_orderkey AS Attestnummer, CAST(year(o_orderdate) AS INTEGER) AS "year"
FROM orders
""")
def csv_scan(spark, sf):
    """The landed rows read back and conformed."""
    rows = conform(scan(spark, probe(spark, land_orders(spark, sf))), ["year"])
    return rows.withColumn("Utstedelsesdato", F.col("Utstedelsesdato").cast("timestamp_ntz"))


@query("""
WITH files AS (
  SELECT year(o_orderdate) AS y, min(o_totalprice) >= 1200 AS ok FROM orders GROUP BY 1, o_orderpriority),
years AS (SELECT y, bool_and(ok) AS ok FROM files GROUP BY 1)
SELECT coalesce(string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) FILTER (ok), '') AS successful_years,
  coalesce(string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) FILTER (NOT ok), '') AS failed_years,
  bool_and(ok) AS total_success
FROM years
""")
def yearly_import_summary(spark, sf):
    """A year is one file per order priority; a file works when no price is below the limit."""
    files = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(
        F.min("o_totalprice").alias("low")
    )
    out = year_summary(files, F.col("low") >= 1200)
    return out.select(
        F.array_join(F.col("successful_years").cast("array<string>"), ",").alias("successful_years"),
        F.array_join(F.col("failed_years").cast("array<string>"), ",").alias("failed_years"),
        "total_success",
    )


@query("""
WITH landing AS (
  SELECT year(o_orderdate) AS y, CASE WHEN count(*) % 3 = 0 THEN 'skipped' WHEN count(*) % 3 = 1 THEN 'downloaded'
    ELSE 'failed' END AS outcome FROM orders GROUP BY 1)
SELECT count(*) AS total_years, count(*) FILTER (outcome = 'downloaded') AS successful_downloads,
  count(*) FILTER (outcome = 'skipped') AS skipped_existing, count(*) FILTER (outcome = 'failed') AS failed_downloads
FROM landing
""")
def yearly_download_summary(spark, sf):
    landing = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    outcome = F.when(F.col("n") % 3 == 0, "skipped").when(F.col("n") % 3 == 1, "downloaded").otherwise("failed")
    return landing_summary(landing.withColumn("outcome", outcome))


@query("""
SELECT doc_id, source, length(k) AS key_chars FROM (
  SELECT doc_id, source, CASE WHEN n_chars >= 200 THEN text END AS k FROM documents)
QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1
""")
def dedupe_keep_first(spark, sf):
    """First document of each text; short ones have no key and collapse to one row.

    The key is a digest of the whole text, so texts stay out of the exchange.
    """
    long = F.col("n_chars") >= 200
    docs = table(spark, sf, "documents").select(
        "doc_id", "source", F.when(long, F.sha2("text", 256)).alias("k"), F.when(long, F.length("text").cast("long")).alias("key_chars")
    )
    return keep_first(docs, ["k"], ["doc_id"]).select("doc_id", "source", "key_chars")


@query("""
SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def new_record_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return new_records(docs, table(spark, sf, "labels"), "doc_id")


@query("""
WITH staged AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS k, l_quantity > 49 AS bad FROM lineitem),
keys AS (SELECT k, count(*) FILTER (NOT bad) AS good, count(*) FILTER (bad) AS bad FROM staged GROUP BY k),
stored AS (SELECT o_orderkey AS k, count(*) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
t AS (SELECT sum(good) AS good, sum(bad) AS bad, count(*) FILTER (good > 0) AS keys,
  count(*) FILTER (good > 0 AND m IS NOT NULL) AS skipped, sum(m) FILTER (good > 0) AS matches
  FROM keys LEFT JOIN stored USING (k))
SELECT CAST(good + bad AS BIGINT) AS total_rows, CAST(good - keys AS BIGINT) AS duplicate_rows,
  keys - skipped AS inserted_rows, skipped AS skipped_rows, CAST(matches AS BIGINT) AS stored_matches,
  CAST(bad AS BIGINT) AS failed_rows, round((keys - skipped) / (keys - skipped + bad) * 100.0, 4) AS insert_rate,
  (keys - skipped > 0 OR skipped > 0) AS success
FROM t
""")
def import_totals(spark, sf):
    """A10 over line items keyed by order: copies, null keys, stored and failed rows."""
    staged = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("k"), (F.col("l_quantity") > 49).alias("bad")
    )
    stored = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    return import_summary(staged, stored, "k", F.col("bad"))


@query("""
SELECT count(*) AS processed, count(*) FILTER (o.k IS NULL) AS added, count(o.k) AS skipped
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON o.k = c_custkey
""")
def idempotent_append(spark, sf):
    """What an append of customers to the ordering ones would add and skip."""
    stored = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return append_new(stored, table(spark, sf, "customer"), ["c_custkey"])[1]


def order_changes(spark, sf, where: str):
    """Line items as changes of their orders, and the orders; both are dealt by the order's key.

    Their number of rows tells the number of tasks. The join is asked to sort, which can spill: by the size of
    a file's keys alone Spark would send millions of orders to every task.
    """
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    n = tasks_for(items, orders)
    orders = orders.repartition(n, "o_orderkey")
    changes = items.where(where).repartition(n, "l_orderkey").join(
        orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return changes.select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), F.col("l_shipdate").alias("changed"), "l_linenumber"
    ), orders


@query("""
WITH incoming AS (
  SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, l_shipdate AS changed, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
latest AS (SELECT o_orderkey, o_custkey, o_orderstatus, changed FROM incoming
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY changed DESC, l_linenumber) = 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate AS changed FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
UNION ALL SELECT * FROM latest
""")
def merge_upsert(spark, sf):
    """Returned line items change their order; the newest change wins."""
    changes, orders = order_changes(spark, sf, "l_returnflag = 'R'")
    stored = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").alias("changed"), F.lit(None).cast("int").alias("l_linenumber")
    )
    return merge(stored, changes, ["o_orderkey"], [F.desc("changed"), F.col("l_linenumber")]).drop("l_linenumber")


@query("""
SELECT user_id, event_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return keep_latest(rows, ["user_id"], F.desc("ts"), F.desc("event_id"))


LANDED_ORDERS = """
SELECT 'enova_data_' || year(o_orderdate) || '.csv' AS filename, '/in/' || o_orderkey || '/' ||
  'enova_data_' || year(o_orderdate) || '.csv' AS full_path, CAST(floor(o_totalprice) AS BIGINT) AS file_size,
  o_orderdate AS modified, CAST(year(o_orderdate) AS INTEGER) AS "year" FROM orders
"""


def _landed_orders(spark, sf):
    name = F.concat(F.lit("enova_data_"), F.year("o_orderdate").cast("string"), F.lit(".csv"))
    return table(spark, sf, "orders").select(
        name.alias("filename"),
        F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string"), F.lit("/"), name).alias("full_path"),
        F.floor("o_totalprice").alias("file_size"),
        F.col("o_orderdate").alias("modified"),
        F.year("o_orderdate").alias("year"),
    )


@query(f"""
WITH f AS ({LANDED_ORDERS}), g AS (SELECT CAST("year" AS VARCHAR) AS "year", filename, sum(file_size) AS b FROM f GROUP BY 1, 2),
r AS (SELECT "year", filename, count(*) AS files, sum(b) AS b FROM g GROUP BY 1, 2 UNION ALL SELECT NULL, NULL, count(*), sum(b) FROM g)
SELECT "year", filename, files, CAST(b AS BIGINT) AS bytes, round(b / 1024 / 1024, 1) AS mb FROM r
""")
def landed_listing(spark, sf):
    """Each order as a landed file."""
    return landed_files(_landed_orders(spark, sf))


@query(f"""
SELECT "year", max_by(full_path, (modified, full_path)) AS latest_path, max(modified) AS latest_modified,
  count(*) AS matching_files
FROM ({LANDED_ORDERS}) GROUP BY 1
""")
def latest_file_per_year(spark, sf):
    return latest_per_year(_landed_orders(spark, sf), F.col("year"))


@query("""
SELECT y AS "year", kind, CASE kind WHEN 'url' THEN 'enova_' || y || '_data.csv'
  WHEN 'dates' THEN 'enova_certificates_' || y || '_' || strftime(a, '%Y%m%d') || '_' || strftime(b, '%Y%m%d') || '.csv'
  ELSE 'enova_certificates_' || y || '_' || strftime(b, '%Y%m%d_%H%M%S') || '.csv' END AS name
FROM (SELECT year(o_orderdate) AS y, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1),
  (VALUES ('url'), ('dates'), ('bad')) k(kind)
""")
def landed_names(spark, sf):
    """One name per year from a URL, from dates and from neither."""
    years = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")
    )
    kinds = years.withColumn("kind", F.explode(F.array(F.lit("url"), F.lit("dates"), F.lit("bad"))))
    url = F.when(F.col("kind") == "url", "https://h/files/data.csv?sig=a.b").otherwise("https://h/files/data?sig=a.b")
    iso = lambda c: F.when(F.col("kind") == "dates", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("x")
    name = landed_name(F.col("year").cast("string"), url, iso("a"), iso("b"), F.col("b"))
    return kinds.select(F.col("year").cast("long").alias("year"), "kind", name.alias("name"))
