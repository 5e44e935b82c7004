from datetime import datetime

import pytest
from pyspark.sql import functions as F

from certflow.operators.reports import sample_files
from certflow.plans import jobs
from certflow.schemas import ANSWERS, API_LOG, CLEANED_TEXT, FILE_EXTRACT, FILE_INVENTORY, IMPORTED
from certflow.sources.files import list_files
from certflow.sources.landing import mark_latest, probe, profile, sample_records, scan
from certflow.sources.tables import data_dictionary, dictionary_markdown, object_counts, read_batches, read_version

T1, T2 = datetime(2025, 1, 1, 10), datetime(2025, 1, 1, 12)


@pytest.fixture
def landed(tmp_path):
    header = "Knr,Attestnummer,GateAdresse,Ukjent"
    (tmp_path / "enova_data_2020.csv").write_bytes(
        ("﻿" + header + '\n1,A1,"Vei 1, ""b""",x\n2,A2,Åsen,x\n9,A1,again,x\n,,,\n3,,first null,x\n4,,second null,x\n').encode())
    (tmp_path / "enova_data_2021.csv").write_bytes("Attestnummer;Knr;GateAdresse\nA3;1;Ås\nA1;2;later\nA3;3;\nA3;4;\nA3;5;\nA9;1;x;too many\n".encode("latin-1"))
    (tmp_path / "enova_data_2022.csv").write_bytes('Attestnummer\tGateAdresse\nA4\t"two\nlines"\nA5\n'.encode())
    (tmp_path / "enova_data_2023.csv").write_bytes(b'foo,bar\n1,rom 5" vei\n')
    return str(tmp_path)


def test_probe_and_scan(spark, landed):
    dialects = probe(spark, landed)
    got = {r.year: (r.encoding, r.separator, r.n_columns, r.multi_line) for r in dialects.collect()}
    assert got == {2020: ("UTF-8", ",", 4, False), 2021: ("ISO-8859-1", ";", 3, False), 2022: ("UTF-8", "\t", 2, True), 2023: ("UTF-8", ",", 2, False)}
    scanned = scan(spark, dialects)
    assert {(r.Attestnummer, r.GateAdresse) for r in scanned.collect()} >= {("A1", 'Vei 1, "b"'), ("A3", "Ås"), ("A4", "two\nlines"), ("A5", None)}
    counts = {r.year: r.total_rows for r in profile(dialects, scanned).collect()}
    assert counts == {2020: 6, 2021: 6, 2022: 2, 2023: 0}
    assert sample_records(scanned, 3).count() == 3 + 3 + 2


def test_import_twice_adds_nothing(spark, landed, root):
    first = jobs.import_certificates(spark, landed, root, "b1").head().asDict()
    assert (first["total_rows"], first["duplicate_rows"], first["inserted_rows"], first["failed_rows"]) == (13, 6, 6, 1)
    stored = read_batches(spark, root, "imported", IMPORTED)
    assert {(r.Attestnummer, r.GateAdresse) for r in stored.collect()} == {
        ("A1", 'Vei 1, "b"'), ("A2", "Åsen"), (None, "first null"), ("A3", "Ås"), ("A4", "two\nlines"), ("A5", None)}
    second = jobs.import_certificates(spark, landed, root, "b2").head()
    # the row without a key is new every time, as no key can match it
    assert (second.inserted_rows, second.skipped_rows) == (1, 5)
    # the same batch again replaces its own output only
    jobs.import_certificates(spark, landed, root, "b2")
    assert read_batches(spark, root, "imported", IMPORTED).count() == 7


def test_rows_without_keys(spark, tmp_path, root):
    (tmp_path / "enova_data_2018.csv").write_text("Knr,Gnr\n1,2\n1,2\n")
    (tmp_path / "enova_data_2019.csv").write_text("Knr,Attestnummer\n1,\n2,\n3,A\n")
    (tmp_path / "enova_data_2020.csv").write_text("Knr,Attestnummer\n4,\n5,A\n")
    got = jobs.import_certificates(spark, str(tmp_path), root, "b1").head()
    # both rows of the file without the key column, one row without a key per other file, one A
    assert (got.total_rows, got.duplicate_rows, got.inserted_rows) == (7, 2, 5)
    stored = read_batches(spark, root, "imported", IMPORTED)
    assert sorted(((r.Knr, r.Attestnummer) for r in stored.collect()), key=str) == [(1.0, None), (1.0, None), (1.0, None), (3.0, "A"), (4.0, None)]


def test_import_of_a_year_range(spark, landed, root):
    report = jobs.import_certificates(spark, landed, root, "b1", (2021, 2024)).head()
    assert report.inserted_rows == 4
    years = jobs.imported_years(spark, root, "b1", (2021, 2024)).head()
    assert tuple(years) == ([2021, 2022], [2023, 2024], False)


def test_latest_files(spark):
    files = spark.createDataFrame([("/a_2020.csv", 1), ("/b_2020.csv", 2), ("/c_2021.csv", 1)], "full_path string, modified int")
    year = F.regexp_extract("full_path", r"_(\d{4})", 1)
    got = {(r.full_path, r.year, r.is_latest) for r in mark_latest(files, year).collect()}
    assert got == {("/a_2020.csv", "2020", False), ("/b_2020.csv", "2020", True), ("/c_2021.csv", "2021", True)}
    listing = spark.createDataFrame([("b.pdf", "/b.pdf", 1048576, ".pdf"), ("a.txt", "/a.txt", 1, ".txt")], "filename string, full_path string, file_size long, file_extension string")
    assert [tuple(r) for r in sample_files(listing).collect()] == [("b.pdf", 1.0)]


def _calls(spark):
    calls = spark.createDataFrame([(i, "A%d" % i) for i in range(1, 5)], "CertificateID long, Attestnummer string")
    for c in ("kommunenummer", "gardsnummer", "bruksnummer", "seksjonsnummer", "bruksenhetnummer", "bygningsnummer"):
        calls = calls.withColumn(c, F.lit("1"))
    return calls


def test_responses(spark, root):
    landed = spark.createDataFrame([(1, 200, '[{"organisasjonsnummer":"1"},{}]'), (2, 200, "[]"), (3, 500, None)],
                                   "CertificateID long, http_status int, body string")
    report = jobs.process_responses(_calls(spark), landed, root, "b1", T1)
    assert {(r.status_message, r.calls, r.records) for r in report.collect()} == {
        ("Success", 1, 2), ("No records found", 2, 0), ("Pending", 1, 0), (None, 4, 2)}
    assert read_version(spark, root, "api_pending", API_LOG).count() == 1
    # the waiting call is answered within its hour, the others are not called again
    late = spark.createDataFrame([(4, 200, "[{}]")], "CertificateID long, http_status int, body string")
    jobs.process_responses(_calls(spark), late, root, "b2", T1.replace(minute=30))
    log = read_batches(spark, root, "api_log", API_LOG)
    assert sorted((r.CertificateID, r.status_message) for r in log.collect()) == [
        (1, "Success"), (2, "No records found"), (3, "No records found"), (4, "Success")]
    assert read_version(spark, root, "api_pending", API_LOG).count() == 0
    assert spark.read.parquet(f"{root}/certificates/batch=b1").count() == 2


def test_stale_calls_are_made_again(spark, root):
    none = spark.createDataFrame([], "CertificateID long, http_status int, body string")
    jobs.process_responses(_calls(spark), none, root, "b1", T1, n=2)
    assert read_version(spark, root, "api_pending", API_LOG).count() == 2
    jobs.process_responses(_calls(spark), none, root, "b2", T2, n=3)
    waiting = read_version(spark, root, "api_pending", API_LOG).collect()
    assert sorted((r.CertificateID, r.LogDate) for r in waiting) == [(1, T2), (2, T2), (3, T2)]


def test_a_repeated_batch_reads_what_the_first_run_read(spark, root):
    none = spark.createDataFrame([], "CertificateID long, http_status int, body string")
    runs = []
    for _ in range(2):
        jobs.process_responses(_calls(spark), none, root, "b1", T1, n=2)
        runs.append(sorted(r.CertificateID for r in read_version(spark, root, "api_pending", API_LOG).collect()))
    assert runs == [[1, 2], [1, 2]]


def test_forced_sync_replaces_rows(spark, root):
    listing = spark.createDataFrame([(f"{i}.pdf", f"/{i}.pdf", i, ".pdf") for i in range(3)], "filename string, full_path string, file_size long, file_extension string")
    jobs.sync_inventory(listing, root, T1)
    for _ in range(2):
        assert tuple(jobs.sync_inventory(listing, root, T2, skip_existing=False).head()) == (3, 3, 0, 0)
    table = read_version(spark, root, "inventory", FILE_INVENTORY)
    assert table.count() == table.select("file_id").distinct().count() == 3
    assert {r.sync_date for r in table.collect()} == {T2}


def test_inventory(spark, root, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.pdf", "sub/b.PDF", "sub/a.pdf", "c.txt", "none"):
        (tmp_path / name).write_bytes(b"x")
    listing = list_files(spark, str(tmp_path))
    assert sorted(r.filename for r in listing.collect()) == ["a.pdf", "a.pdf", "b.PDF"]
    assert {r.file_extension for r in list_files(spark, str(tmp_path), None).collect()} == {".pdf", ".txt", ""}
    assert tuple(jobs.sync_inventory(listing, root, T1).head()) == (3, 3, 0, 0)
    (tmp_path / "sub" / "b.PDF").unlink()
    (tmp_path / "d.pdf").write_bytes(b"x")
    assert tuple(jobs.sync_inventory(list_files(spark, str(tmp_path)), root, T2).head()) == (3, 1, 2, 1)
    table = read_version(spark, root, "inventory", FILE_INVENTORY)
    assert sorted(r.filename for r in table.collect()) == ["a.pdf", "a.pdf", "d.pdf"]


def test_cleaning(spark, root):
    extracts = spark.createDataFrame([(1, "Page 1\nhello worldAgain here"), (2, "short"), (3, "Page 1\n12\n---\nPage 22222")], "file_id long, extracted_text string")
    report = jobs.clean_texts(extracts, root, "b1", T1).head()
    assert (report.processed, report.successful, report.failed, report.success_pct) == (3, 1, 2, 33.3333)
    assert [r.clean_text for r in read_batches(spark, root, "cleaned", CLEANED_TEXT).collect()] == ["hello world Again here"]
    assert jobs.clean_texts(extracts, root, "b2", T2).head().processed == 2


def test_answers(spark, root):
    prompts = spark.createDataFrame([(1, "p"), (2, "q"), (3, " ")], "FILE_ID long, V1 string")
    replies = spark.createDataFrame([(1, "V1", "Eiendom: a\nPositive ting: b\nKort vurdering: c")], "file_id long, prompt_version string, response_text string")
    report = jobs.parse_answers(prompts, replies, root, "b1", T1, "V1").head()
    assert (report.processed, report.successful) == (2, 1)
    answer = read_batches(spark, root, "answers", ANSWERS).head()
    assert (answer.AboutEstate, answer.Positives, answer.Evaluation, answer.Created) == ("a", "b", "c", T1)
    assert jobs.parse_answers(prompts, replies, root, "b2", T2, "V1").head().processed == 1


def test_downloads_and_extracts(spark, root):
    urls = spark.createDataFrame([("https://h/a.pdf", "a.pdf"), ("https://h/b.pdf", "b.pdf")], "attest_url string, expected_filename string")
    tried = spark.createDataFrame([("https://h/a.pdf", False, None, 200, None, None, None, "%PDF", 2000), ("https://h/b.pdf", False, None, 404, None, None, None, None, None)],
                                  "attest_url string, exists boolean, existing_size long, http_status int, http_error string, error string, content_length long, content_head string, size long")
    assert jobs.record_downloads(urls, tried, root, "b1", T1).head().successful == 1
    assert jobs.record_downloads(urls, tried, root, "b2", T2).head().processed == 1
    listing = spark.createDataFrame([("a.pdf", "/a.pdf", 2000, ".pdf")], "filename string, full_path string, file_size long, file_extension string")
    jobs.sync_inventory(listing, root, T1)
    parsed = spark.createDataFrame([("/a.pdf", True, "long enough text", None, 3)], "full_path string, exists boolean, text string, error string, page_count int")
    assert jobs.record_extracts(parsed, root, "b1", T1).head().successful == 1
    assert jobs.record_extracts(parsed, root, "b2", T2).head().processed == 0
    assert read_batches(spark, root, "extracts", FILE_EXTRACT).head().character_count == 16


def test_a_failing_stage_does_not_stop_the_rest(spark, root):
    def fails():
        raise ValueError("x" * 300)

    got = jobs.run_stages(spark, {"one": fails, "two": lambda: spark.range(30).toDF("n")}, root, "b1").collect()
    assert [(r.stage, r.success) for r in got] == [("one", False), ("two", True)]
    assert len(got[0].error) == 200 and spark.read.parquet(got[1].report).count() == 30


def test_catalog(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    df.createOrReplaceTempView("catalog_probe")
    got = data_dictionary({"t": df}).orderBy("position").collect()
    assert [(r.table_name, r.column_name, r.data_type, r.row_count) for r in got] == [("t", "n", "int", 1), ("t", "s", "string", 1)]
    lines = [r.value for r in dictionary_markdown(data_dictionary({"t": df})).collect()]
    assert lines[0].startswith("\n## t\n\nRows: 1") and lines[1:] == [" | n | int | yes |", " | s | string | yes |"]
    assert object_counts(spark).filter("schema_name = 'temporary' AND columns >= 2").count() == 1
