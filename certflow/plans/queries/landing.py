"""S1, S4, S6, L4, J12 at rest: files and tables that grow by batches, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from certflow.plans import jobs
from certflow.plans.queries.imports import land_orders, order_changes
from certflow.plans.queries.registry import query, table
from certflow.schemas import IMPORTED, QUARANTINE
from certflow.session import scratch_dir
from certflow.sources.buckets import merge_buckets, purge_buckets, read_buckets, write_buckets
from certflow.sources.files import changed_files, list_files, list_tree, scan_manifest
from certflow.sources.landing import dialects_of, land_chunks, scan_chunks
from certflow.sources.tables import append_batch, drop_folded, fold_batches, read_batches
from certflow.streaming import import_available, import_epoch


@query("""
SELECT 'D' || doc_id AS Attestnummer, nullif(source, '') AS Poststed, lang AS Knr, md5(text) AS text_md5, length(text)::BIGINT AS n_chars
FROM documents
""")
def csv_multiline(spark, sf):
    """Documents, line feeds and quotes included, as quoted fields of CSV files, read by splits and put together."""
    root = scratch_dir(spark, "multiline")
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("Attestnummer"), F.col("source").alias("Poststed"),
        F.col("lang").alias("Knr"), F.col("text").alias("GateAdresse"), F.concat(F.lit("enova_data_2024_"), "lang", F.lit(".csv")).alias("landed"))
    (rows.write.partitionBy("landed").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/in"))
    chunks = land_chunks(spark, f"{root}/in", f"{root}/chunks")
    return scan_chunks(chunks, dialects_of(chunks)).select(
        "Attestnummer", "Poststed", "Knr", F.md5("GateAdresse").alias("text_md5"), F.length("GateAdresse").cast("long").alias("n_chars"))


def land_customers(spark, sf, root: str) -> str:
    """Customers as lines of a file for each third of the nations, some with fields beyond the header, and one file whose last quote never closes."""
    customers = table(spark, sf, "customer").withColumn("landed", F.format_string("enova_data_2023_%s.csv", F.col("c_nationkey") % 3))
    line = F.concat_ws(",", F.concat(F.lit("A"), F.col("c_custkey").cast("string")), F.col("c_nationkey").cast("string"), "c_mktsegment")
    line = F.when(F.col("c_custkey") % 10 == 3, F.concat(line, F.lit(",more,and more"))).otherwise(line)
    heads = customers.select("landed", F.lit(0).alias("n"), F.lit("Attestnummer,Knr,Poststed").alias("value")).distinct()
    # the first rows, of which the dialect is told, are whole ones
    lines = customers.select("landed", F.when(F.col("c_custkey") % 10 == 3, F.lit(2)).otherwise(F.lit(1)).alias("n"), line.alias("value"), "c_custkey")
    lines = lines.unionByName(heads, allowMissingColumns=True)
    lines.repartition("landed").sortWithinPartitions("landed", "n", "c_custkey").select("landed", "value").write.partitionBy("landed").text(f"{root}/in")
    spark.createDataFrame([("Attestnummer,Knr,Poststed",), ("B1,1,x",), ("B2,2,x",), ("B3,3,x",), ("B4,4,x",), ("B5,5,x",), ('B6,6,"open',), ("B7,7,y",)], "value string"
                          ).coalesce(1).write.text(f"{root}/in/enova_data_2024.csv")
    return f"{root}/in"


@query(r"""
SELECT 'more fields than the header' AS reason, 2023 AS "year",
  '{"Knr":"' || c_nationkey || '","Poststed":"' || c_mktsegment || '","Attestnummer":"A' || c_custkey || '","overflow":"more"}' AS record
FROM customer WHERE c_custkey % 10 = 3
UNION ALL SELECT 'quote without an end', 2024, '{"Knr":"6","Poststed":"open\nB7,7,y","Attestnummer":"B6"}'
""")
def quarantine(spark, sf):
    """The rows that an import keeps apart, with the reason, after the batch ran twice."""
    root = scratch_dir(spark, "quarantine")
    landed = land_customers(spark, sf, root)
    for _ in range(2):
        jobs.import_certificates(spark, landed, root, "b1")
    return read_batches(spark, root, "quarantine", QUARANTINE).select("reason", "year", "record")


@query("""
SELECT 'A' || c_custkey AS Attestnummer, CAST(c_nationkey AS DOUBLE) AS Knr, c_mktsegment AS Poststed FROM customer WHERE c_custkey % 10 <> 3
UNION ALL SELECT 'B' || i, i, 'x' FROM range(1, 6) t(i)
""")
def quarantine_rest(spark, sf):
    """What is imported beside the rows kept apart."""
    root = scratch_dir(spark, "quarantine-rest")
    jobs.import_certificates(spark, land_customers(spark, sf, root), root, "b1")
    return read_batches(spark, root, "imported", IMPORTED).select("Attestnummer", "Knr", "Poststed")


@query("""
SELECT p_partkey, p_name, CASE WHEN p_size % 20 = 7 THEN 'again' ELSE 'first' END AS run FROM part
""")
def folded_batches(spark, sf):
    """Parts in twenty batches, folded twice on the way; one batch is written anew after it was folded."""
    root, parts = scratch_dir(spark, "folds"), table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    rows = lambda k, run: parts.where(F.col("p_size") % 20 == k).select("p_partkey", "p_name", F.lit(run).alias("run"))
    schema = rows(0, "first").schema
    for k in range(20):
        append_batch(rows(k, "first"), root, "parts", f"b{k:02}")
        if k in (8, 15):
            fold_batches(spark, root, "parts", schema, least=4)
    append_batch(rows(7, "again"), root, "parts", "b07")
    drop_folded(spark, root, "parts")
    return read_batches(spark, root, "parts", schema)


@query("""
WITH incoming AS (
  SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, l_shipdate AS changed, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_orderkey % 1009 < 3),
latest AS (SELECT o_orderkey, o_custkey, o_orderstatus, changed FROM incoming
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY changed DESC, l_linenumber) = 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate AS changed FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest) AND o_orderkey % 503 <> 1
UNION ALL SELECT * FROM latest WHERE o_orderkey % 503 <> 1
""")
def merge_touched(spark, sf):
    """Returned line items of few orders change a bucketed table, and some orders leave it; each batch runs twice."""
    root, orders = scratch_dir(spark, "buckets"), table(spark, sf, "orders")
    changes = order_changes(spark, sf, "l_returnflag = 'R' AND l_orderkey % 1009 < 3")[0]
    rows = orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").alias("changed"))
    write_buckets(rows, root, "orders", ["o_orderkey"], 64)
    for _ in range(2):
        merge_buckets(changes, root, "orders", rows.schema, ["o_orderkey"], [F.desc("changed"), F.col("l_linenumber")], "b1")
        purge_buckets(spark, root, "orders", rows.schema, ["o_orderkey"], orders.where("o_orderkey % 503 = 1"))
    return read_buckets(spark, root, "orders", rows.schema)


def _write_texts(spark, sf, folder: str, where: str) -> None:
    rows = table(spark, sf, "documents").where(where).select("text", "source", "lang")
    rows.write.mode("append").partitionBy("source", "lang").option("compression", "none").text(folder)


@query("""
SELECT 'listed' AS change, source, lang, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes FROM documents GROUP BY source, lang
UNION ALL SELECT 'added', source, lang, sum(octet_length(encode(text)) + 1)::BIGINT FROM documents WHERE lang = 'fr' GROUP BY source, lang
UNION ALL SELECT 'removed', source, lang, sum(octet_length(encode(text)) + 1)::BIGINT FROM documents WHERE lang = 'fr' GROUP BY source, lang
""")
def manifest_changes(spark, sf):
    """Text files listed folder by folder in tasks, what a second landing adds, and the same seen backwards as removed."""
    root = scratch_dir(spark, "manifest")
    _write_texts(spark, sf, f"{root}/in", "lang <> 'fr'")
    scan_manifest(spark, [f"{root}/in"], root, "b1", "*.txt")
    _write_texts(spark, sf, f"{root}/in", "lang = 'fr'")
    for _ in range(2):
        added = scan_manifest(spark, [f"{root}/in"], root, "b2", "*.txt")
    listed = list_tree(spark, [f"{root}/in"], f"{root}/levels", "*.txt").select("full_path", F.lit("listed").alias("change"), F.col("file_size").alias("new_size"))
    before = list_files(spark, f"{root}/in", "*.txt").where(~F.col("full_path").contains("/lang=fr/"))
    removed = changed_files(list_files(spark, f"{root}/in", "*.txt"), before)
    rows = listed.unionByName(added.select("full_path", "change", "new_size")).unionByName(
        removed.select("full_path", "change", F.col("old_size").alias("new_size")))
    part = lambda name: F.regexp_extract("full_path", f"/{name}=([^/]*)/", 1).alias(name)
    return rows.groupBy("change", part("source"), part("lang")).agg(F.sum("new_size").alias("bytes"))


@query("""
SELECT CAST(o_custkey AS DOUBLE) AS Knr, CAST(o_totalprice AS VARCHAR) AS BeregnetFossilandel,
  'Åsveien; nr ' || o_orderkey || ', "A"' AS GateAdresse, date_trunc('second', o_orderdate) AS Utstedelsesdato,
  'Energiattest-' || o_orderkey AS Attestnummer
FROM orders
""")
def stream_import(spark, sf):
    """S1 to L5 as a stream: two landings, and the first one's batch handed out again."""
    root = scratch_dir(spark, "stream")
    for where in ("o_orderkey % 3 = 0", "o_orderkey % 3 <> 0"):
        import_available(spark, land_orders(spark, sf, where, f"{root}/in"), root)
    first = spark.read.parquet(f"{root}/stream_files/batch=stream-{0:012}")
    import_epoch(first, 0, root)
    rows = read_batches(spark, root, "imported", IMPORTED)
    return rows.select("Knr", "BeregnetFossilandel", "GateAdresse",
                       F.col("Utstedelsesdato").cast("timestamp_ntz").alias("Utstedelsesdato"), "Attestnummer")
