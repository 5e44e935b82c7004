import math
import random

import pytest
from pyspark.sql import functions as F

from certflow.operators.procedures import register_procedures
from certflow.operators.quantiles import ERROR, merged, quantiles, sketch
from certflow.operators.responses import known_paths, parse_bodies, unknown_fields
from certflow.plans import jobs
from certflow.schemas import CALL_COLUMNS, FILE_INVENTORY
from certflow.sources.tables import pinned_version, write_version

SHARES = [0.0001, 0.1, 0.5, 0.9, 1.0]


def test_quantiles_are_within_their_bound(spark):
    rng = random.Random(2)
    rows = [(g, rng.choice([0.0, -1, 1]) * 10 ** rng.uniform(-3, 6)) for g in "abc" for _ in range(700)] + [("d", 5.0), ("e", None), ("e", float("nan"))]
    frame = spark.createDataFrame(rows, "g string, v double").withColumn("batch", F.xxhash64("v") % 3)
    got = {(r.g, r.share): r.estimate for r in quantiles(sketch(frame, ["g"], "v"), ["g"], SHARES).collect()}
    assert {g for g, _ in got} == set("abcd")
    for (g, share), estimate in got.items():
        values = sorted(v for k, v in rows if k == g)
        exact = values[max(0, math.ceil(share * len(values)) - 1)]
        assert abs(estimate - exact) <= abs(exact) * (ERROR + 1e-9), (g, share)
    by_batch = merged(sketch(frame, ["g", "batch"], "v"), ["g"])
    assert {(r.g, r.share): r.estimate for r in quantiles(by_batch, ["g"], SHARES).collect()} == got


def test_percentiles_of_cleaning_batches(spark, root):
    extracts = spark.createDataFrame([(k, f"a text that stays as it is {k}" + "\nPage 1" * (k % 3)) for k in range(20)], "file_id long, extracted_text string")
    from datetime import datetime

    report = jobs.clean_texts(extracts.where("file_id < 10"), root, "b1", datetime(2025, 1, 1)).head()
    jobs.clean_texts(extracts, root, "b2", datetime(2025, 1, 2))
    assert report.seconds > 0 and report.rows_per_second > 0
    got = {(r.outcome, r.share): r.estimate for r in jobs.cleaning_percentiles(spark, root, [0.1, 1.0]).collect()}
    assert got["success", 0.1] == 0 and 25 < got["success", 1.0] < 40


def test_procedures_from_sql(spark):
    calls = spark.range(20).withColumnRenamed("id", "CertificateID")
    for c in CALL_COLUMNS[1:]:
        calls = calls.withColumn(c, F.lit("1"))
    made = register_procedures(spark, {"certificates": calls, "api_log": spark.createDataFrame([(0,), (1,), (1,), (None,)], "CertificateID long")})
    assert made == ["api_worklist"]
    ids = lambda text: [r.CertificateID for r in spark.sql(text).collect()]
    assert sorted(ids("SELECT * FROM api_worklist(3)")) == [2, 3, 4]
    assert sorted(ids("SELECT * FROM api_worklist()")) == list(range(2, 20)) and ids("SELECT * FROM api_worklist(0)") == []
    plan = lambda text: spark.sql(text)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan("SELECT * FROM api_worklist(3)")
    assert "Window" not in plan("SELECT * FROM api_worklist()")


def test_unknown_fields(spark):
    bodies = [
        (1, 200, '[{"energiattest":{"versjon":2,"attestnummer":"A"},"ny":{"a":[1,null]}},{},null,7]'), (2, 200, '{"title":"x"}'), (3, 200, "[broken"),
        (4, 500, '[{"ny":1}]'), (5, 200, None), (6, 200, '[{"enhet":{"bygg":{"etasjer":"3","kategori":{"x":1}},"matrikkel":5}}]'), (7, 200, "[]"),
    ]
    frame = spark.createDataFrame(bodies, "CertificateID long, http_status int, body string")
    found = unknown_fields(frame)
    assert sorted(map(tuple, found.collect())) == [
        (1, 0, "energiattest.versjon", "2"), (1, 0, "ny", '{"a":[1,null]}'), (6, 0, "enhet.bygg.etasjer", '"3"')]
    assert found._jdf.queryExecution().analyzed().toString().count("parse_json") == 1
    assert known_paths(spark.createDataFrame([], "a struct<b:int,c:array<struct<d:int>>>").schema) == {"a": True, "a.b": False, "a.c": False, "a.c.d": False}


@pytest.mark.parametrize("body, n, returned", [
    ('[{"organisasjonsnummer":"1"},null]', 2, 2), (" \n[ ]", 0, 0), ('{"a":1,"b":2}', None, 2), ("[1,2]", None, 2), ("[broken", None, None), (None, None, None),
    ("7", None, None), ("", None, None),
])
def test_bodies_are_parsed_once(spark, body, n, returned):
    rows = parse_bodies(spark.createDataFrame([(1, 200, body), (2, 500, body)], "CertificateID long, http_status int, body string"))
    got = {r.CertificateID: (None if r.certificates is None else len(r.certificates), r.returned) for r in rows.collect()}
    assert got == {1: (n, returned), 2: (None, None)}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_a_batch_reads_the_version_that_it_read_first(spark, root):
    rows = lambda name: spark.createDataFrame([(name,) + (None,) * 5], FILE_INVENTORY)
    names = lambda batch: [r.file_id for r in pinned_version(spark, root, "inventory", FILE_INVENTORY, "user", batch).collect()]
    assert names("b0") == []
    write_version(rows("one"), root, "inventory", "v1")
    assert names("b0") == [] and names("b1") == ["one"]
    write_version(rows("two"), root, "inventory", "v2")
    assert names("b1") == ["one"] and names("b2") == ["two"]
