"""Responses, call outcomes and the log: S5, P9, P10, P14, L1-L3, L6, A1, X19."""

from __future__ import annotations

from pyspark.sql import functions as F

from certflow.operators.lifecycle import archive, expire_pending, log_pending, resolve_pending
from certflow.operators.reports import status_breakdown
from certflow.operators.responses import call_outcomes, flatten, parse_bodies, untyped_values
from certflow.operators.spread import spread
from certflow.operators.worklists import api_worklist
from certflow.plans.queries.joins import CALLS
from certflow.plans.queries.registry import query, table
from certflow.schemas import CALL_COLUMNS, RESPONSE_SCHEMA

BATCH_TIME = "2025-01-02 03:04:05"


def order_calls(spark, sf):
    """Each order as a call whose landed body holds one certificate, two, or none.

    The second object has no `enhet`; orders of low priority have no `registering`.
    """
    orders = spread(table(spark, sf, "orders"), "o_orderkey")
    rows = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    low = F.col("o_orderpriority") == "5-LOW"
    registering = F.when(~low, F.struct(
        F.col("o_orderpriority").alias("type"),
        F.col("o_totalprice").alias("beregnetLevertEnergiTotaltkWhm2"),
        (F.col("o_orderstatus") == "F").alias("harEnergivurdering"),
    ))
    key = F.col("o_orderkey").cast("string")
    attest = F.struct(
        F.concat(F.lit("EA-"), key).alias("attestnummer"),
        F.concat(F.lit("https://h/x/EA-"), key, F.lit(".pdf?sig=1")).alias("attestUrl"),
        F.col("o_orderstatus").alias("energikarakter"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("utstedelsesdato"),
        registering.alias("registering"),
    )
    enhet = F.struct(
        F.col("c_acctbal").alias("bruksareal"),
        F.struct(F.col("c_name").alias("gatenavn"), F.lit("ÅS").alias("poststed")).alias("adresse"),
        F.struct(F.col("c_nationkey").cast("string").alias("kommunenummer"),
                 F.col("c_custkey").cast("string").alias("gårdsnummer")).alias("matrikkel"),
        F.struct(F.year("o_orderdate").alias("byggeår"), F.col("c_mktsegment").alias("kategori")).alias("bygg"),
    )
    first = F.struct(F.col("c_mktsegment").alias("organisasjonsnummer"), attest.alias("energiattest"), enhet.alias("enhet"))
    second = F.struct(F.lit("second").alias("organisasjonsnummer"), attest.alias("energiattest"),
                      F.when(F.lit(False), enhet).alias("enhet"))
    one, two = F.to_json(F.array(first)), F.to_json(F.array(first, second))
    made = F.when(F.col("o_orderkey") % 3 == 0, two).otherwise(one)
    # some values come as JSON of another type, some areas are no numbers
    quoted = F.regexp_replace(made, '"(harEnergivurdering|byggeår|bruksareal)":(true|false|-?[0-9.E]+)', '"$1":"$2"')
    spoiled = F.regexp_replace(made, '"bruksareal":-?[0-9.E]+', '"bruksareal":"ukjent"')
    body = (F.when(F.col("o_orderkey") % 10 == 9, "[]").when(F.col("o_orderkey") % 4 == 0, quoted)
            .when(F.col("o_orderkey") % 4 == 1, spoiled).otherwise(made))
    return rows.select(
        F.col("o_orderkey").alias("CertificateID"),
        F.col("c_nationkey").cast("string").alias("kommunenummer"),
        *[F.lit(None).cast("string").alias(c) for c in CALL_COLUMNS[2:7]],
        F.concat(F.lit("EA-"), key).alias("Attestnummer"),
        F.lit(200).alias("http_status"),
        body.alias("body"),
    )


# The 38 columns of a flat row, and what the orders put into some of them.
FLAT = (
    "ImportDate CertificateID paramKommunenummer paramGardsnummer paramBruksnummer paramSeksjonsnummer paramBruksenhetnummer "
    "paramBygningsnummer attestnummer merkenummer bruksareal energikarakter oppvarmingskarakter attest_url "
    "matrikkel_kommunenummer matrikkel_gardsnummer matrikkel_bruksnummer matrikkel_festenummer matrikkel_seksjonsnummer "
    "matrikkel_andelsnummer matrikkel_bruksenhetsnummer bygg_bygningsnummer bygg_byggear bygg_kategori bygg_type "
    "utstedelsesdato adresse_gatenavn adresse_postnummer adresse_poststed registering_RegisteringType "
    "registering_BeregnetLevertEnergiTotaltkWhm2 registering_BeregnetLevertEnergiTotaltkWh registering_HarEnergivurdering "
    "registering_Energivurderingdato registering_BeregnetFossilandel registering_Materialvalg OrganisasjonsNummer Created").split()
FILLED = {
    "ImportDate": "TIMESTAMP '2025-01-02 03:04:05'", "Created": "TIMESTAMP '2025-01-02 03:04:05'", "CertificateID": "o_orderkey",
    "paramKommunenummer": "CAST(c_nationkey AS VARCHAR)", "attestnummer": "'EA-' || o_orderkey", "merkenummer": "'EA-' || o_orderkey",
    "bruksareal": "CASE WHEN part = 1 AND o_orderkey % 4 <> 1 THEN c_acctbal END", "energikarakter": "o_orderstatus",
    "attest_url": "'https://h/x/EA-' || o_orderkey || '.pdf?sig=1'", "utstedelsesdato": "strftime(o_orderdate, '%Y-%m-%d')",
    "matrikkel_kommunenummer": "CASE part WHEN 1 THEN CAST(c_nationkey AS VARCHAR) END",
    "matrikkel_gardsnummer": "CASE part WHEN 1 THEN CAST(c_custkey AS VARCHAR) END",
    "bygg_byggear": "CASE part WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) END", "bygg_kategori": "CASE part WHEN 1 THEN c_mktsegment END",
    "adresse_gatenavn": "CASE part WHEN 1 THEN c_name END", "adresse_poststed": "CASE part WHEN 1 THEN 'ÅS' END",
    "registering_RegisteringType": "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END",
    "registering_BeregnetLevertEnergiTotaltkWhm2": "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END",
    "registering_HarEnergivurdering": "CASE WHEN o_orderpriority <> '5-LOW' THEN CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END END",
    "OrganisasjonsNummer": "CASE part WHEN 1 THEN c_mktsegment ELSE 'second' END",
}
FLAT_NUMBERS = ("registering_BeregnetLevertEnergiTotaltkWh", "registering_BeregnetFossilandel")


def _flat_sql(name: str) -> str:
    return FILLED.get(name, f"CAST(NULL AS {'DOUBLE' if name in FLAT_NUMBERS else 'VARCHAR'})") + f" AS {name}"


@query(f"""
WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 10 <> 9),
n AS (SELECT *, 1 AS part FROM o UNION ALL SELECT *, 2 FROM o WHERE o_orderkey % 3 = 0)
SELECT {", ".join(map(_flat_sql, FLAT))} FROM n
""")
def response_flatten(spark, sf):
    """Nested bodies to flat rows, with values of mixed JSON types."""
    flat = flatten(parse_bodies(order_calls(spark, sf)), F.lit(BATCH_TIME).cast("timestamp"))
    return flat.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ImportDate", "Created")})


@query("""
SELECT o_orderkey AS CertificateID, 0 AS object, 'bruksareal' AS "column", 'ukjent' AS text
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 10 <> 9 AND o_orderkey % 4 = 1
""")
def response_untyped(spark, sf):
    """The numbers that are no numbers, kept apart."""
    return untyped_values(parse_bodies(order_calls(spark, sf)))


@query("""
SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS events, round(sum(CAST(round(value * 100) AS BIGINT)) / 100.0, 2) AS total
FROM events GROUP BY 1
""")
def event_props(spark, sf):
    """S5 on flat JSON."""
    rows = table(spark, sf, "events").select(F.from_json("props", "k int").alias("p"), "value")
    cents = F.round(F.col("value") * 100).cast("long")
    return rows.groupBy(F.col("p.k").alias("k")).agg(
        F.count("*").alias("events"), F.round(F.sum(cents) / 100.0, 2).alias("total")
    )


# Events as calls: the type gives the HTTP status, the body and the client-side error.
EVENT_CALLS = [
    "event_id AS CertificateID",
    "CASE event_type WHEN 'signup' THEN 400 WHEN 'error' THEN 500 ELSE 200 END AS http_status",
    """CASE WHEN event_type = 'signup' AND event_id % 2 = 0
         THEN '{"errors":{"EnergiattestResponse":["Query gave More than twenty five hits"]}}'
       WHEN event_type = 'signup' THEN '{"errors":{"Other":["x"]}}'
       WHEN event_type = 'view' THEN '[]' WHEN event_type = 'click' THEN '[{"organisasjonsnummer":"1"},{}]'
       WHEN event_type = 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN '[null]' WHEN event_id % 3 = 1 THEN '{"title":"maintenance","code":503}'
           ELSE '[{"organisasjonsnummer":"1"},null]' END END AS body""",
    "CASE WHEN event_type = 'purchase' AND value > 20 THEN concat('time out ', repeat('x', 250)) END AS error",
]


@query("""
SELECT event_id AS CertificateID,
  CASE WHEN event_type = 'click' THEN 2 WHEN event_type = 'purchase' AND value <= 20 THEN CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END ELSE 0 END::BIGINT AS records_returned,
  CASE WHEN event_type = 'purchase' AND value > 20 THEN 'Error: time out ' || repeat('x', 191)
    WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'Too many results (25+ eiendommer)'
    WHEN event_type = 'purchase' AND event_id % 3 <> 2 THEN 'API returned data but no records saved'
    WHEN event_type IN ('click', 'purchase') THEN 'Success' ELSE 'No records found' END AS status_message,
  CASE WHEN event_type = 'purchase' AND value > 20 THEN 'error'
    WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'too_many' WHEN event_type IN ('signup', 'error') THEN 'http_failure'
    WHEN event_type = 'view' THEN 'empty' WHEN event_type = 'purchase' AND event_id % 3 <> 2 THEN 'not_saved' ELSE 'saved' END AS outcome_detail
FROM events
""")
def response_status(spark, sf):
    """P14, X19."""
    return call_outcomes(parse_bodies(table(spark, sf, "events").selectExpr(*EVENT_CALLS)))


def _event_log(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("CertificateID"), F.col("ts").alias("LogDate"),
        F.when(F.col("event_type") != "error", F.round("value").cast("long")).alias("records_returned"),
        F.when(F.col("event_type").isin("view", "click"), "Pending").otherwise(F.col("event_type")).alias("status_message"),
    )


@query("""
WITH first AS (SELECT o_custkey AS id, CAST(o_orderkey AS BIGINT) AS n, 'Status ' || o_orderstatus AS s FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
SELECT event_id, user_id AS CertificateID, ts AS LogDate,
  CASE WHEN event_type IN ('view', 'click') AND s IS NOT NULL THEN n
    WHEN event_type <> 'error' THEN CAST(round(value) AS BIGINT) END AS records_returned,
  CASE WHEN event_type IN ('view', 'click') THEN coalesce(s, 'Pending') ELSE event_type END AS status_message
FROM events LEFT JOIN first ON user_id = id
""")
def resolve_log(spark, sf):
    """L2: each customer's first order resolves all its pending events."""
    outcomes = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("CertificateID"), F.col("o_orderkey").alias("records_returned"),
        F.concat(F.lit("Status "), "o_orderstatus").alias("status_message"),
    )
    return resolve_pending(_event_log(spark, sf), outcomes, ["records_returned"])


@query("""
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'Pending' ELSE event_type END AS status_message FROM events
WHERE NOT (event_type IN ('view', 'click') AND ts < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 24 HOUR)
""")
def expire_log(spark, sf):
    """L3: pending events older than a day at a fixed time go."""
    as_of = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return expire_pending(_event_log(spark, sf), as_of, 24).select("event_id", "status_message")


@query(f"""
SELECT c_custkey AS CertificateID, CAST(c_nationkey AS VARCHAR) AS kommunenummer, c_name AS Attestnummer,
  CAST(NULL AS BIGINT) AS records_returned, 'Pending' AS status_message, TIMESTAMP '{BATCH_TIME}' AS LogDate
FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def log_new_calls(spark, sf):
    """L1: one pending row per call to make."""
    log = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("CertificateID"))
    work = api_worklist(table(spark, sf, "customer").selectExpr(*CALLS), log)
    rows = log_pending(work, F.lit(BATCH_TIME).cast("timestamp"))
    return rows.select(
        "CertificateID", "kommunenummer", "Attestnummer", "records_returned", "status_message",
        F.col("LogDate").cast("timestamp_ntz").alias("LogDate"),
    )


@query("""
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'Pending' ELSE event_type END AS status_message, count(*) AS calls,
  CAST(sum(coalesce(CASE WHEN event_type <> 'error' THEN CAST(round(value) AS BIGINT) END, 0)) AS BIGINT) AS records
FROM events GROUP BY ROLLUP (1)
""")
def status_totals(spark, sf):
    """A1 over all events."""
    return status_breakdown(_event_log(spark, sf))


@query("""
SELECT CASE WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 'archive' ELSE 'rest' END AS part, event_id FROM events
""")
def archive_split(spark, sf):
    """L6."""
    rows = table(spark, sf, "events").select("event_id", F.col("ts").alias("Created"))
    old, rest = archive(rows, F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return old.select(F.lit("archive").alias("part"), "event_id").unionByName(rest.select(F.lit("rest").alias("part"), "event_id"))


@query("SELECT o_orderkey AS CertificateID, CASE WHEN o_orderkey % 10 = 9 THEN 0 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS objects FROM orders JOIN customer ON o_custkey = c_custkey")
def response_sizes(spark, sf):
    """Number of objects per landed body."""
    rows = order_calls(spark, sf).select("CertificateID", F.from_json("body", RESPONSE_SCHEMA).alias("c"))
    return rows.select("CertificateID", F.size("c").alias("objects"))
