"""Worklists, reconciliation, dimensions and scalar rules: J2-J9, J11, U1, P8-P13, X18, F1."""

from __future__ import annotations

from pyspark.sql import functions as F

from certflow.functions.scalars import (
    certificate_number, energy_score, file_name_from_url, register_sql_functions, request_payload,
)
from certflow.operators.lifecycle import purge_gone
from certflow.operators.reconcile import missing, shared, side_counts
from certflow.operators.reports import directory_stats
from certflow.operators.worklists import (
    api_worklist, clean_worklist, extract_worklist, gone_files, new_files, prompt_worklist, prompts_long, url_worklist,
)
from certflow.plans.queries.registry import query, table
from certflow.sources.dims import BUILDING_TYPES, RATINGS, STATUSES, building_types, look_up, ratings, statuses
from certflow.session import scratch_dir
from certflow.sources.files import list_files

PROMPTS = [
    "doc_id AS FILE_ID",
    "CASE WHEN doc_id % 7 = 0 THEN '   ' WHEN doc_id % 7 = 1 THEN NULL ELSE text END AS PROMPT_V1_NOR",
    "CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END AS PROMPT_V2_NOR",
]
ANSWERED = ["doc_id AS file_id", "CASE WHEN quality = 1 THEN 'PROMPT_V1_NOR' ELSE 'PROMPT_V2_NOR' END AS PromptVersion"]
PROMPT_SQL = f"""
WITH p AS (SELECT {", ".join(PROMPTS)} FROM documents), a AS (SELECT {", ".join(ANSWERED)} FROM labels),
long AS (SELECT FILE_ID AS file_id, 'PROMPT_V1_NOR' AS prompt_version, PROMPT_V1_NOR AS prompt_text FROM p
  UNION ALL SELECT FILE_ID, 'PROMPT_V2_NOR', PROMPT_V2_NOR FROM p),
todo AS (SELECT * FROM long WHERE prompt_text IS NOT NULL AND length(trim(prompt_text, ' ')) > 0 AND NOT EXISTS (
  SELECT 1 FROM a WHERE a.file_id = long.file_id AND a.PromptVersion = long.prompt_version))
"""


def _prompts(spark, sf):
    return table(spark, sf, "documents").selectExpr(*PROMPTS), table(spark, sf, "labels").selectExpr(*ANSWERED)


@query(PROMPT_SQL + """SELECT file_id, prompt_version, md5(prompt_text) AS prompt_md5 FROM todo
WHERE prompt_version = 'PROMPT_V1_NOR' ORDER BY file_id LIMIT 50""")
def prompt_next(spark, sf):
    """The next fifty prompts of one version."""
    work = prompt_worklist(*_prompts(spark, sf), "PROMPT_V1_NOR", 50)
    return work.select("file_id", "prompt_version", F.md5("prompt_text").alias("prompt_md5"))


@query(PROMPT_SQL + "SELECT file_id, prompt_version, md5(prompt_text) AS prompt_md5 FROM todo")
def prompt_backlog(spark, sf):
    """Everything left to ask in both versions."""
    work = prompt_worklist(*_prompts(spark, sf), ["PROMPT_V1_NOR", "PROMPT_V2_NOR"])
    return work.select("file_id", "prompt_version", F.md5("prompt_text").alias("prompt_md5"))


@query(PROMPT_SQL + """SELECT prompt_version, count(*) AS rows_total, count(prompt_text) AS rows_set,
CAST(sum(length(prompt_text)) AS BIGINT) AS chars FROM long GROUP BY 1""")
def prompt_versions(spark, sf):
    """Prompt columns as rows."""
    return prompts_long(_prompts(spark, sf)[0], ["PROMPT_V1_NOR", "PROMPT_V2_NOR"]).groupBy("prompt_version").agg(
        F.count("*").alias("rows_total"), F.count("prompt_text").alias("rows_set"),
        F.sum(F.length("prompt_text")).alias("chars"),
    )


CALLS = [
    "c_custkey AS CertificateID",
    "cast(c_nationkey AS string) AS kommunenummer",
    "CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN ' ' WHEN c_custkey % 4 = 2 THEN NULL ELSE '0' END AS gardsnummer",
    "cast(c_custkey % 50 AS string) AS bruksnummer",
    "cast(NULL AS string) AS seksjonsnummer",
    "CASE WHEN c_custkey % 2 = 0 THEN concat('H', cast(c_custkey AS string)) END AS bruksenhetnummer",
    "c_mktsegment AS bygningsnummer",
    "c_name AS Attestnummer",
]


@query(f"""
WITH c AS (SELECT {", ".join(CALLS)} FROM customer)
SELECT CertificateID, Attestnummer, '{{' || concat_ws(',', '"kommunenummer":"' || kommunenummer || '"',
  CASE WHEN gardsnummer NOT IN ('', ' ') THEN '"gardsnummer":"' || gardsnummer || '"' END,
  '"bruksnummer":"' || bruksnummer || '"', '"bruksenhetnummer":"' || bruksenhetnummer || '"',
  '"bygningsnummer":"' || bygningsnummer || '"') || '}}' AS payload
FROM c WHERE CertificateID NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def api_backlog(spark, sf):
    """Customers without an urgent order, with their request payload."""
    log = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("CertificateID"))
    work = api_worklist(table(spark, sf, "customer").selectExpr(*CALLS), log)
    payload = request_payload({c: F.col(c) for c in work.columns})
    return work.select("CertificateID", "Attestnummer", payload.alias("payload"))


URL_NAME_SQL = "'energiattest_' || sha256(url) || '.pdf'"


@query(f"""
SELECT DISTINCT url AS attest_url, {URL_NAME_SQL} AS expected_filename FROM pages
WHERE url NOT IN (SELECT url FROM pages WHERE length(html) > 2000)
  AND {URL_NAME_SQL} NOT IN (SELECT {URL_NAME_SQL} FROM pages WHERE length(html) < 500)
""")
def url_backlog(spark, sf):
    """Long pages count as downloaded, short ones as being on disk."""
    pages = table(spark, sf, "pages").select(F.col("url").alias("attest_url"), F.length("html").alias("size"))
    pages = pages.withColumn("expected_filename", file_name_from_url(F.col("attest_url")))
    log = pages.select("attest_url", F.when(F.col("size") > 2000, "Success").otherwise("HTTP Error").alias("status"))
    disk = pages.filter("size < 500").select(F.col("expected_filename").alias("filename"))
    named = pages.drop("size")
    return url_worklist(named, disk, log)


@query("""
SELECT doc_id AS file_id, source || '/' || doc_id || '.pdf' AS filename FROM documents
WHERE lang <> 'en' AND doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY filename, file_id LIMIT 100
""")
def extract_next(spark, sf):
    """Documents in English stand for files that are no PDF."""
    files = table(spark, sf, "documents").select(
        F.col("doc_id").alias("file_id"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"),
        F.when(F.col("lang") == "en", ".txt").otherwise(".PDF").alias("file_extension"),
    )
    done = table(spark, sf, "labels").select(F.col("doc_id").alias("file_id"))
    return extract_worklist(files, done, 100).select("file_id", "filename")


@query("""
SELECT doc_id AS file_id, length(text) AS chars FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 100
""")
def clean_next(spark, sf):
    """J6."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), "text")
    done = table(spark, sf, "labels").select(F.col("doc_id").alias("file_id"))
    return clean_worklist(docs, done, 100).select("file_id", F.length("text").cast("long").alias("chars"))


def _inventory(spark, sf):
    """Customers are the files on disk; customers seen in orders, and some line items, the table."""
    path = F.concat(F.lit("/pdf/"), F.col("filename"))
    name = lambda c: F.concat(F.lit("f"), F.col(c).cast("string"), F.lit(".pdf")).alias("filename")
    disk = table(spark, sf, "customer").select(name("c_custkey")).withColumn("full_path", path)
    stored = table(spark, sf, "orders").select(name("o_custkey")).distinct().withColumn("full_path", path)
    gone = table(spark, sf, "part").filter("p_size > 45").select(
        F.concat(F.lit("old"), F.col("p_partkey").cast("string"), F.lit(".pdf")).alias("filename")
    ).withColumn("full_path", F.when(F.length("filename") % 2 == 0, path))
    return disk, stored.unionByName(gone)


INVENTORY_SQL = """
WITH disk AS (SELECT 'f' || c_custkey || '.pdf' AS filename, '/pdf/f' || c_custkey || '.pdf' AS full_path FROM customer),
stored AS (SELECT DISTINCT 'f' || o_custkey || '.pdf' AS filename, '/pdf/f' || o_custkey || '.pdf' AS full_path FROM orders
  UNION ALL SELECT 'old' || p_partkey || '.pdf', CASE WHEN length('old' || p_partkey || '.pdf') % 2 = 0
    THEN '/pdf/old' || p_partkey || '.pdf' END FROM part WHERE p_size > 45)
"""


@query(INVENTORY_SQL + """
SELECT 'kept' AS action, filename FROM stored WHERE full_path IN (SELECT full_path FROM disk)
UNION ALL SELECT 'deleted', filename FROM stored WHERE full_path IS NULL OR full_path NOT IN (SELECT full_path FROM disk)
UNION ALL SELECT 'added', filename FROM disk WHERE filename NOT IN (SELECT filename FROM stored)
""")
def inventory_sync(spark, sf):
    """What a sync keeps, deletes and adds."""
    disk, stored = _inventory(spark, sf)
    parts = {"kept": purge_gone(stored, disk), "deleted": gone_files(stored, disk), "added": new_files(disk, stored)}
    out = None
    for action, rows in parts.items():
        rows = rows.select(F.lit(action).alias("action"), "filename")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(INVENTORY_SQL + """
SELECT CASE WHEN d.filename IS NOT NULL AND s.filename IS NOT NULL THEN 'both' WHEN s.filename IS NULL THEN 'left_only'
  ELSE 'right_only' END AS side, count(*) AS names, min(coalesce(d.filename, s.filename)) AS first_name,
  max(coalesce(d.filename, s.filename)) AS last_name
FROM (SELECT DISTINCT filename FROM disk) d FULL JOIN (SELECT DISTINCT filename FROM stored) s ON d.filename = s.filename
GROUP BY 1
""")
def reconcile_sets(spark, sf):
    """J9."""
    return side_counts(*_inventory(spark, sf), "filename")


@query("""
SELECT 'missing' AS kind, p_brand AS name FROM (SELECT p_brand FROM part WHERE p_size < 3 EXCEPT SELECT p_brand FROM part WHERE p_size > 40)
UNION ALL SELECT 'shared', p_brand FROM (SELECT p_brand FROM part WHERE p_size < 3 INTERSECT SELECT p_brand FROM part WHERE p_size > 40)
""")
def name_sets(spark, sf):
    """Brands of small parts against brands of large ones."""
    part = table(spark, sf, "part")
    small, large = part.filter("p_size < 3"), part.filter("p_size > 40")
    lost = missing(small, large, "p_brand").select(F.lit("missing").alias("kind"), F.col("p_brand").alias("name"))
    return lost.unionByName(shared(small, large, "p_brand").select(F.lit("shared").alias("kind"), F.col("p_brand").alias("name")))


def landed_texts(spark, sf):
    """The documents as text files in folders by source and language, and the listing of these files."""
    folder = scratch_dir(spark, "texts")
    rows = table(spark, sf, "documents").select("text", "source", "lang")
    rows.write.partitionBy("source", "lang").option("compression", "none").text(folder)
    return list_files(spark, folder, "*.txt")


@query("""
SELECT source, lang, '.txt' AS file_extension, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes, true AS named
FROM documents GROUP BY source, lang
""")
def inventory_listing(spark, sf):
    """The landed text files by metadata only; a line of text has its bytes and a line feed."""
    part = lambda name: F.regexp_extract("full_path", f"/{name}=([^/]*)/", 1).alias(name)
    return landed_texts(spark, sf).groupBy(part("source"), part("lang"), "file_extension").agg(
        F.sum("file_size").alias("bytes"), F.bool_and(F.col("full_path").endswith(F.col("filename"))).alias("named"))


@query("""
SELECT file_extension, bytes::BIGINT AS bytes, round(bytes / 1024.0 / 1024.0, 1) AS mb FROM (
  SELECT '.txt' AS file_extension, sum(octet_length(encode(text)) + 1) AS bytes FROM documents
  UNION ALL SELECT NULL, sum(octet_length(encode(text)) + 1) FROM documents)
""")
def directory_totals(spark, sf):
    """A9 over the landed text files; how many files they are is up to the writer."""
    return directory_stats(landed_texts(spark, sf)).drop("files")


def _values(rows):
    def lit(v):
        return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


@query(f"""
SELECT p_partkey, RatingName, SortOrder, TypeName, Category, StatusName, IsActive
FROM part
LEFT JOIN (VALUES {_values(RATINGS)}) r(RatingCode, RatingName, d, SortOrder) ON RatingCode = substr('ABCDEFGHIJ', p_size % 10 + 1, 1)
LEFT JOIN (VALUES {_values(BUILDING_TYPES)}) b(TypeID, TypeCode, TypeName, Category)
  ON TypeCode = CASE p_type WHEN 'ECONOMY' THEN 'RES_HOUSE' WHEN 'SMALL' THEN 'COM_OFFICE' WHEN 'LARGE' THEN 'PUB_SCHOOL' END
LEFT JOIN (VALUES {_values(STATUSES)}) s(StatusID, StatusCode, StatusName, d2, IsActive)
  ON StatusCode = CASE WHEN p_size > 25 THEN 'COMPLETED' ELSE 'PENDING' END
""")
def dim_lookup(spark, sf):
    """Parts named through all three dimensions."""
    part = table(spark, sf, "part").selectExpr(
        "p_partkey", "substr('ABCDEFGHIJ', p_size % 10 + 1, 1) AS rating",
        "CASE p_type WHEN 'ECONOMY' THEN 'RES_HOUSE' WHEN 'SMALL' THEN 'COM_OFFICE' WHEN 'LARGE' THEN 'PUB_SCHOOL' END AS kind",
        "CASE WHEN p_size > 25 THEN 'COMPLETED' ELSE 'PENDING' END AS state",
    )
    part = look_up(part, ratings(spark).drop("Description"), "rating", "RatingCode")
    part = look_up(part, building_types(spark), "kind", "TypeCode")
    part = look_up(part, statuses(spark), "state", "StatusCode")
    return part.select("p_partkey", "RatingName", "SortOrder", "TypeName", "Category", "StatusName", "IsActive")


RATED = [
    "p_partkey",
    """CASE WHEN p_size % 13 = 0 THEN NULL WHEN p_size % 13 = 1 THEN '' WHEN p_size % 13 = 2 THEN 'A          x'
       WHEN p_size % 13 = 3 THEN concat(' ', lower(substr('ABCDEFGHIJ', p_size % 10 + 1, 1)), ' ')
       ELSE substr('ABCDEFGHIJ', p_size % 10 + 1, 1) END AS rating""",
]
SCORE_SQL = """CASE upper(trim(left(rating, 10))) WHEN 'A' THEN 100 WHEN 'B' THEN 85 WHEN 'C' THEN 70 WHEN 'D' THEN 55
  WHEN 'E' THEN 40 WHEN 'F' THEN 25 WHEN 'G' THEN 10 ELSE 0 END"""


@query(f"SELECT p_partkey, rating, {SCORE_SQL} AS score, {SCORE_SQL} AS sql_score FROM (SELECT {', '.join(RATED)} FROM part)")
def energy_scores(spark, sf):
    """X18 as a column rule and F1 as a SQL function."""
    register_sql_functions(spark)
    return table(spark, sf, "part").selectExpr(*RATED).select(
        "p_partkey", "rating", energy_score(F.col("rating")).alias("score"),
        F.expr("calculate_energy_score(rating)").alias("sql_score"),
    )


CRAFTED = [
    ("plain", "concat('https://h/', page_id, '/b', page_id, '.pdf?x=1#top')", "'b' || page_id || '.pdf'"),
    ("upper", "concat('https://h/', page_id, '/B.PDF')", None),
    ("filename", "concat('https://h/get?a=1&filename=c', page_id, '.pdf')", "'c' || page_id || '.pdf'"),
    ("encoded", "concat('https://h/x?rscd=attachment%3B%20filename%3Dd', page_id, '.pdf%3Bz')", "'d' || page_id || '.pdf'"),
    ("quoted", "concat('https://h/x?name=%22e.pdf%22&file=f', page_id, '.pdf')", "'f' || page_id || '.pdf'"),
    ("illegal", "concat('https://h/a:b*', page_id, '.pdf')", "'a_b_' || page_id || '.pdf'"),
    ("page", "url", None),
]


@query(" UNION ALL ".join(
    f"SELECT page_id, '{kind}' AS kind, {name or f'''{chr(39)}energiattest_{chr(39)} || sha256({url}) || {chr(39)}.pdf{chr(39)}'''} AS file_name, "
    f"{dict(plain='concat(chr(98), page_id)', upper='chr(66) || chr(46) || chr(80) || chr(68) || chr(70)').get(kind, 'NULL') } AS certificate FROM pages"
    for kind, url, name in CRAFTED
))
def url_file_names(spark, sf):
    """Names for each page's URL and for URLs built from its id."""
    pages = table(spark, sf, "pages")
    crafted = F.array(*[F.struct(F.lit(kind).alias("kind"), F.expr(url).alias("u")) for kind, url, _ in CRAFTED])
    rows = pages.select("page_id", F.inline(crafted))
    certificate = F.when(F.col("kind").isin("plain", "upper"), certificate_number(F.col("u")))
    return rows.select("page_id", "kind", file_name_from_url(F.col("u")).alias("file_name"), certificate.alias("certificate"))
