from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from certflow.functions.scalars import (
    energy_score, file_name_from_url, landed_name, not_blank, register_sql_functions, request_payload, whole_mb,
)
from certflow.operators import reports as R, spread
from certflow.operators.conform import conform, keep_first
from certflow.operators.lifecycle import append_new, archive, expire_pending, merge, purge_gone, resolve_pending
from certflow.operators.outcomes import call_outcome, cleaning_outcome, download_outcome, extraction_outcome
from certflow.operators.prompts import extract_facts
from certflow.operators.reconcile import missing, shared, side_counts
from certflow.operators.responses import call_outcomes, flatten, parse_bodies
from certflow.operators.skew import salted_join
from certflow.operators.worklists import gone_files, new_files, not_done, prompt_worklist, url_worklist
from certflow.plans.queries import QUERIES


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conform_edge_rows(spark):
    raw = spark.createDataFrame(
        [
            ("12a", " 1987 ", "2025-04-15T00:00:00", "   ", "27,5", "True", "A1", "x"),
            ("12d", "1e3", "15.04.2025", "nan", "1", "Ja", "A2", "x"),
            ("inf", "NaN", "xx", "NA", None, "False", " A3 ", "x"),
            ("", None, "", "", "", "", "", "x"),
        ],
        "Gnr string, Byggear string, Utstedelsesdato string, GateAdresse string, BeregnetFossilandel string, "
        "HarEnergiVurdering string, Attestnummer string, Extra string",
    )
    out = conform(raw)
    assert "Extra" not in out.columns
    got = out.orderBy("Attestnummer").collect()
    assert len(got) == 3
    assert [r.Gnr for r in got] == [None, None, None]
    assert [r.Byggear for r in got] == [1987.0, 1000.0, None]
    assert [r.Utstedelsesdato for r in got] == [datetime(2025, 4, 15), datetime(2025, 4, 15), None]
    assert [r.GateAdresse for r in got] == ["", None, None]
    assert [r.BeregnetFossilandel for r in got] == ["27.5", "1", None]
    assert [r.HarEnergiVurdering for r in got] == ["True", None, "False"]
    assert [r.Attestnummer for r in got] == ["A1", "A2", "A3"]
    with pytest.raises(ValueError):
        conform(raw.select("Extra"))


def test_keep_first_collapses_null_keys_and_limits_before_the_exchange(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 4), (None, 3), ("b", 5)], "k string, p int")
    first = keep_first(df, ["k"], ["p"])
    assert rows(first, "p") == [("a", 1), (None, 3), ("b", 5)]
    assert plan(first).count("WindowGroupLimit") == 2


def test_anti_joins_keep_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k int")
    done = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    for spread in ("", "nulls", "keys"):
        assert sorted(r.k or 0 for r in not_done(df, done, ["k"], spread).collect()) == [0, 0, 2]


def test_heavy_keys_are_cut_by_their_count(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, "hot").when(F.col("id") < 800, None).otherwise(F.col("id").cast("string")).alias("k"), "id")
    unique = spark.createDataFrame([("hot", 1), ("900", 2), ("none", 3)], "k string, v int")
    for heavy in (None, 10, 10**6):
        out = salted_join(rows, unique, ["k"], "left", heavy)
        assert out.count() == 1000 and out.columns == ["k", "id", "v"]
        assert dict(out.groupBy("v").count().collect()) == {1: 700, 2: 1, None: 299}


def test_hot_keys_are_spread_and_results_stay_whole(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("filename"),
                                   F.col("id").cast("string").alias("full_path"))
    seen = spark.createDataFrame([("hot",), ("hot",), ("1",)], "filename string")
    assert new_files(hot, seen).count() == 2000 - 1
    assert new_files(hot, seen.filter("filename = '1'")).count() == 3000 - 1
    assert new_files(hot, seen, skip_existing=False).count() == 3000
    log = hot.select(F.col("filename").alias("CertificateID"), F.lit("Pending").alias("status_message"),
                     F.lit(None).cast("long").alias("records_returned"), "full_path")
    out = resolve_pending(log, spark.createDataFrame([("hot", 2, "Success"), ("hot", 1, "Late")],
                                                     "CertificateID string, records_returned long, status_message string"))
    counts = dict(rows(out.groupBy("status_message").count()))
    assert counts == {"Late": 1000, "Pending": 2000}


def test_prompt_worklist(spark):
    prompts = spark.createDataFrame([(1, "a", "b"), (2, None, "c"), (3, "", "d"), (4, "  ", None), (5, "e", "f")], "FILE_ID int, V1 string, V2 string")
    answers = spark.createDataFrame([(5, "V1"), (1, "V2")], "file_id int, PromptVersion string")
    assert rows(prompt_worklist(prompts, answers, "V1").select("file_id")) == [(1,)]
    assert rows(prompt_worklist(prompts, answers, "V2", 2).select("file_id")) == [(2,), (3,)]
    both = prompt_worklist(prompts, answers, ["V1", "V2"]).select("file_id", "prompt_version")
    assert rows(both, "file_id", "prompt_version") == [(1, "V1"), (2, "V2"), (3, "V2"), (5, "V2")]


def test_url_worklist(spark):
    urls = spark.createDataFrame([("https://a", "x.pdf"), ("https://a", "w.pdf"), ("https://b", "y.pdf"), ("https://c", "z.pdf"), ("ftp", "q.pdf"), (None, "n.pdf")],
                                 "attest_url string, expected_filename string")
    disk = spark.createDataFrame([("y.pdf",)], "filename string")
    log = spark.createDataFrame([("https://c", "Success"), ("https://a", "HTTP Error")], "attest_url string, status string")
    assert rows(url_worklist(urls, disk, log)) == [("https://a", "w.pdf")]


def test_inventory_changes(spark):
    disk = spark.createDataFrame([("a.pdf", "/a.pdf"), ("b.pdf", "/s/b.pdf")], "filename string, full_path string")
    table = spark.createDataFrame([("a.pdf", "/a.pdf"), ("b.pdf", "/b.pdf"), ("n", None)], "filename string, full_path string")
    assert rows(gone_files(table, disk), "filename") == [("b.pdf", "/b.pdf"), ("n", None)]
    assert rows(purge_gone(table, disk)) == [("a.pdf", "/a.pdf")]
    assert rows(side_counts(disk, table, "filename"), "side") == [("both", 2, "a.pdf", "b.pdf"), ("right_only", 1, "n", "n")]
    assert rows(missing(table, disk, "filename")) == [("n",)]
    assert rows(shared(table, disk, "filename"), "filename") == [("a.pdf",), ("b.pdf",)]


def test_log_changes(spark):
    t0, t1 = datetime(2025, 1, 1, 12), datetime(2025, 1, 2, 12)
    log = spark.createDataFrame([(1, t0, None, "Pending"), (1, t1, None, "Pending"), (2, t0, 3, "Success"), (3, datetime(2025, 1, 1, 11, 59, 59), None, "Pending")],
                                "CertificateID long, LogDate timestamp, records_returned long, status_message string")
    outcome = spark.createDataFrame([(1, 5, "Success"), (2, 9, "No")], "CertificateID long, records_returned long, status_message string")
    assert [(r[0], r[2], r[3]) for r in rows(resolve_pending(log, outcome), "CertificateID", "LogDate")] == [
        (1, 5, "Success"), (1, 5, "Success"), (2, 3, "Success"), (3, None, "Pending")]
    assert expire_pending(log, F.lit(t1), 24).filter("CertificateID = 3").count() == 0
    assert expire_pending(log, F.lit(t1), 24).count() == 3
    old, rest = archive(log.withColumnRenamed("LogDate", "Created"), F.lit(t1))
    assert (old.count(), rest.count()) == (3, 1)


def test_append_and_merge(spark):
    stored = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "k string, v int, t int")
    incoming = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "k string, v int, t int")
    added, counts = append_new(stored, incoming, ["k"])
    assert rows(added) == [("c", 4, 1)] and rows(counts) == [(3, 1, 2)]
    merged = merge(stored, incoming, ["k"], [F.desc("t")])
    assert rows(merged, "k") == [("a", 1, 0), ("b", 3, 2), ("c", 4, 1)]
    again = merge(merged, incoming, ["k"], [F.desc("t")])
    assert rows(again, "k") == rows(merged, "k")


def test_payload(spark):
    df = spark.createDataFrame([(0, "", " ", None, "H1", "7")], "kommunenummer int, gardsnummer string, bruksnummer string, seksjonsnummer string, bruksenhetnummer string, bygningsnummer string")
    assert df.select(request_payload({c: F.col(c) for c in df.columns})).head()[0] == '{"kommunenummer":"0","bruksenhetnummer":"H1","bygningsnummer":"7"}'


@pytest.mark.parametrize("url,name", [
    ("https://h/a/b.pdf", "b.pdf"), ("https://h/get?filename=c.pdf", "c.pdf"),
    ("https://h/x?rscd=attachment%3B%20filename%3Dd.pdf", "d.pdf"), ("https://h/x?rscd=a%3B%20filename%3D%22d.pdf%22%3Bx", "d.pdf"),
    ("https://h/a:b.pdf", "a_b.pdf"), ("https://h/a.pdf;v=1?file=z.pdf", "a.pdf"), ("https://h/x?filename=&filename=q.pdf", "q.pdf"),
    ("https://h/x?file=no&name=y%20z.pdf", "y z.pdf"), ("https://h/x?name=a+b.pdf#t", "a b.pdf"), ("p.pdf", "p.pdf"),
    ("https://h/blob", None), ("https://h/B.PDF", None), ("https://h/x?filename=U.PDF&file=a.pdf", None), ("http://[bad", None), ("", None),
])
def test_file_names(spark, url, name):
    got = spark.createDataFrame([(url,)], "u string").select(file_name_from_url(F.col("u"))).head()[0]
    if name is None:
        assert got.startswith("energiattest_") and got.endswith(".pdf") and len(got) == 81
    else:
        assert got == name


def test_scores(spark):
    df = spark.createDataFrame([("A",), (" b ",), ("H",), ("",), (None,), ("A          x",), ("          A",)], "rating string")
    register_sql_functions(spark)
    got = df.select(energy_score(F.col("rating")), F.expr("calculate_energy_score(rating)")).collect()
    assert [r[0] for r in got] == [r[1] for r in got] == [100, 85, 0, 0, 0, 100, 0]


def test_small_rules(spark):
    df = spark.createDataFrame([("  ", 3 * 1024 * 1024 - 1), ("\t", 1024 * 1024)], "s string, n long")
    assert [r[0] for r in df.select(not_blank(F.col("s"))).collect()] == [False, True]
    assert [r[0] for r in df.select(whole_mb(F.col("n"))).collect()] == [2, 1]
    names = spark.createDataFrame([("https://h/a.csv?x", "", ""), ("https://h.b/a", "2024-01-01T00:00:00Z", "2024-12-31"), ("", "x", "")], "u string, a string, b string")
    got = names.select(landed_name(F.lit("2024"), F.col("u"), F.col("a"), F.col("b"), F.lit(datetime(2025, 1, 2, 3, 4, 5)))).collect()
    assert [r[0] for r in got] == ["enova_2024_a.csv", "enova_certificates_2024_20240101_20241231.csv", "enova_certificates_2024_20250102_030405.csv"]


def test_call_outcomes(spark):
    df = spark.createDataFrame(
        [(1, 200, '[{"organisasjonsnummer":"1"},{}]', None), (2, 200, "[]", None), (3, 500, None, None),
         (4, 400, '{"errors":{"EnergiattestResponse":["gave More than twenty five"]}}', None), (5, 400, "{}", None),
         (6, 200, "[1", None), (7, 200, "[{}]", "e" * 300), (8, None, None, None)],
        "CertificateID int, http_status int, body string, error string")
    got = rows(call_outcomes(parse_bodies(df)), "CertificateID")
    assert [g[1] for g in got] == [2, 0, 0, 0, 0, 0, 0, 0]
    assert [g[2] for g in got] == ["Success", "No records found", "No records found", "Too many results (25+ eiendommer)",
                                   "No records found", "No records found", "Error: " + "e" * 200, "No records found"]
    assert [g[3] for g in got] == ["saved", "empty", "http_failure", "too_many", "http_failure", "empty", "error", "http_failure"]
    unsaved = df.select(*call_outcome(F.lit(200), F.lit("x"), F.lit(2), F.lit(0), F.lit(None).cast("string"))).head()
    assert unsaved[:2] == (2, "API returned data but no records saved")


def test_flatten(spark):
    body = ('[{"organisasjonsnummer":"9","energiattest":{"attestnummer":"A","attestUrl":"https://h/x/A-1.pdf?s",'
            '"registering":{"harEnergivurdering":true}},"enhet":null},{"energiattest":{"attestUrl":"https://h/x"},'
            '"enhet":{"bygg":{"byggeår":1999},"matrikkel":{"gårdsnummer":"7"}}}]')
    df = spark.createDataFrame([(1, 200, body), (2, 200, "[]"), (3, 500, None)], "CertificateID long, http_status int, body string")
    for c in ("kommunenummer", "gardsnummer", "bruksnummer", "seksjonsnummer", "bruksenhetnummer", "bygningsnummer"):
        df = df.withColumn(c, F.lit("p"))
    flat = flatten(parse_bodies(df), F.lit(datetime(2025, 1, 1)))
    assert len(flat.columns) == 38 and plan(flat).count("from_json") == 1
    a, b = flat.collect()
    assert (a.merkenummer, a.registering_HarEnergivurdering, a.bruksareal, a.OrganisasjonsNummer) == ("A-1", "True", None, "9")
    assert (b.merkenummer, b.bygg_byggear, b.matrikkel_gardsnummer) == ("x", "1999", "7")


def test_download_outcomes(spark):
    df = spark.createDataFrame(
        [(1, True, 9, None, None, None, None, None, None), (2, False, None, 404, None, None, None, None, None),
         (3, False, None, None, "reset", None, None, None, None), (4, False, None, 200, None, "disk", None, None, None),
         (5, False, None, 200, None, None, 52428801, "x", 1), (6, False, None, 200, None, None, 52428800, "%PDF", 52428800),
         (7, False, None, 200, None, None, None, "<HTML", 1023), (8, False, None, 200, None, None, None, "ok", 1023),
         (9, False, None, 200, None, None, None, "error", 1024)],
        "i int, x boolean, es long, hs int, he string, e string, cl long, h string, s long")
    got = rows(df.select("i", *download_outcome(*[F.col(c) for c in ("x", "es", "hs", "he", "e", "cl", "h", "s")])), "i")
    assert [g[1] for g in got] == ["Already Exists", "HTTP Error", "HTTP Error", "Error", "File Too Large", "Success",
                                   "Invalid Content", "Success", "Success"]
    assert got[4][2] == "File too large: 52,428,801 bytes (max 50MB)"


def test_extraction_and_cleaning_outcomes(spark):
    df = spark.createDataFrame([(1, False, 1, "x" * 20, None), (2, True, 52428801, "x" * 20, None), (3, True, 52428800, "x" * 9 + "  ", None),
                                (4, True, 5, " " + "x" * 10, None), (5, True, 5, None, None), (6, True, 5, "x" * 20, "boom")],
                               "i int, there boolean, size long, body string, e string")
    got = rows(df.select("i", *extraction_outcome(F.lit("p"), F.col("there"), F.col("size"), F.col("body"), F.col("e"))), "i")
    assert [g[4] for g in got] == ["FILE_NOT_FOUND", "FILE_TOO_LARGE", "SUCCESS_LOW_CONTENT", "SUCCESS", "SUCCESS_LOW_CONTENT", "EXTRACTION_ERROR"]
    assert [g[3] for g in got] == [0, 0, 0, 11, 0, 0]
    assert got[2][1] == "EXTRACTION FAILED: Extracted text too short (11 chars)"
    pairs = spark.createDataFrame([("x" * 9, "abcdef"), ("x" * 10, "abcd"), ("x" * 10, "abcde"), (None, None)], "a string, b string")
    assert [r[0] for r in pairs.select(cleaning_outcome(F.col("a"), F.col("b"))).collect()] == ["raw_too_short", "cleaned_too_short", "success", "raw_too_short"]


def test_reports(spark):
    staged = spark.createDataFrame([("a", None), ("a", None), (None, None), (None, None), ("s", None), ("bad", "x")], "k string, o string")
    stored = spark.createDataFrame([("s",), ("s",), ("other",)], "k string")
    got = R.import_summary(staged, stored, "k", F.col("o").isNotNull()).head().asDict()
    assert got == {"total_rows": 6, "duplicate_rows": 2, "inserted_rows": 2, "skipped_rows": 1, "stored_matches": 2,
                   "failed_rows": 1, "insert_rate": 66.6667, "success": True}
    empty = R.import_summary(staged.filter("false"), stored, "k").head()
    assert (empty.total_rows, empty.insert_rate, empty.success) == (0, 100.0, False)
    years = spark.createDataFrame([(2020, True), (2021, False), (2021, True), (2019, True)], "year int, ok boolean")
    assert rows(R.year_summary(years, F.col("ok"))) == [([2019, 2020], [2021], False)]
    log = spark.createDataFrame([("A", 1), ("A", None), ("B", 4)], "status_message string, records_returned long")
    assert set(rows(R.status_breakdown(log))) == {("A", 2, 1), ("B", 1, 4), (None, 3, 5)}
    answers = spark.createDataFrame([(1, "V", "a", "b", "c", 1), (2, "V", " ", "Ikke tilgjengelig i responsen", "c", 2)],
                                    "file_id int, PromptVersion string, AboutEstate string, Positives string, Evaluation string, Created int")
    done = R.answer_completeness(answers, "V").head()
    assert (done.has_about_estate, done.has_positives, done.real_positives, done.pct_about_estate) == (1, 2, 1, 50.0)
    assert R.answers_view(answers).count() == 1


def test_facts(spark):
    text = "energimerke med Energikarakter B og Oppvarmingskarakter Grønn. 'Energiattest-2025-107518' Byggeår er 1987. kWh/m2: 86.16. Energikarakter C"
    got = spark.createDataFrame([(text,), ("Energikarakter Best",)], "t string").select(*extract_facts(F.col("t"))).collect()
    assert tuple(got[0]) == ("B", "Grønn", "Energiattest-2025-107518", 1987, 86.16)
    assert tuple(got[1]) == (None, None, None, None, None)


def test_type_edges(spark):
    from certflow.operators.conform import to_number, to_time

    seen = ["1e999", "-1e999", "12", "12:30:00", "T10:00", "2024-01-02", "2024-01-02 03:04:05", "02.01.2024"]
    got = [tuple(r) for r in spark.createDataFrame([(x,) for x in seen], "x string").select(to_number(F.col("x")), to_time(F.col("x")).cast("string")).collect()]
    assert [g[0] for g in got] == [None, None, 12.0] + [None] * 5
    assert [g[1] for g in got][3:7] == [None, None, "2024-01-02 00:00:00", "2024-01-02 03:04:05"]
    raw = spark.createDataFrame([("true",), ("TRUE",), ("False",), ("x",)], "HarEnergiVurdering string")
    assert [r[0] for r in conform(raw).collect()] == ["True", "True", "False"] or [r[0] for r in conform(raw).collect()] == ["True", "True", "False", None]


def test_responses_keep_values_of_any_type(spark):
    from certflow.operators.responses import call_outcomes, flatten, parse_bodies, untyped_values

    bodies = [
        (1, '[{"enhet":{"bruksareal":"364.00","bygg":{"byggeår":"1987"}},"energiattest":{"registering":{"beregnetFossilandel":"27","harEnergivurdering":"true"}}}]'),
        (2, '[{"enhet":{"bruksareal":12.5,"bygg":{"byggeår":1987}},"energiattest":{"registering":{"beregnetFossilandel":"n/a","harEnergivurdering":false}}}]'),
        (3, "[null]"), (4, '{"title":"maintenance"}'), (5, "[]"), (6, "no json"), (7, None),
    ]
    calls = spark.createDataFrame([(i, 200, b) for i, b in bodies], "CertificateID long, http_status int, body string")
    for p in ("kommunenummer", "gardsnummer", "bruksnummer", "seksjonsnummer", "bruksenhetnummer", "bygningsnummer"):
        calls = calls.withColumn(p, F.lit("1"))
    parsed = parse_bodies(calls)
    flat = flatten(parsed, F.lit("2025-01-02").cast("timestamp"))
    assert len(flat.columns) == 38
    names = ["bruksareal", "bygg_byggear", "registering_BeregnetFossilandel", "registering_HarEnergivurdering"]
    assert [tuple(r) for r in flat.orderBy("CertificateID").select(names).collect()] == [
        (364.0, "1987", 27.0, "True"), (12.5, "1987", None, "False")]
    assert [tuple(r) for r in untyped_values(parsed).collect()] == [(2, 0, "registering_BeregnetFossilandel", "n/a")]
    status = {r.CertificateID: (r.records_returned, r.status_message) for r in call_outcomes(parsed).collect()}
    assert status == {
        1: (1, "Success"), 2: (1, "Success"), 3: (1, "API returned data but no records saved"),
        4: (1, "API returned data but no records saved"), 5: (0, "No records found"), 6: (0, "No records found"), 7: (0, "No records found")}


def test_merge_of_large_tables_stays_small_in_each_task(spark, root, monkeypatch):
    monkeypatch.setattr(spread, "ROWS_PER_TASK", 500, raising=False)
    t0 = datetime(2024, 1, 1)
    orders = [(k, k % 7, "O", t0) for k in range(3000)] + [(None, 1, "O", t0)]
    items = [(k, i, "R" if (k + i) % 3 == 0 else "N", t0 + timedelta(days=i)) for k in range(0, 3000, 2) for i in range(4)] + [(None, 1, "R", t0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp").write.parquet(f"{root}/lineitem.parquet")
    last = {k: t for k, _, flag, t in items if flag == "R" and k is not None}  # dates rise with the line's number
    want = [(k, c, "X", last[k]) if k in last else (k, c, s, t) for k, c, s, t in orders]
    merged = QUERIES["merge_upsert"](spark, root)
    # no order goes to all tasks, and 9,002 rows make 19 tasks where the session has 8 partitions
    assert "BroadcastHashJoin [l_orderkey" not in plan(merged) and "hashpartitioning(l_orderkey" in plan(merged)
    assert merged.rdd.getNumPartitions() >= 19
    assert sorted(map(str, rows(merged))) == sorted(map(str, want))
