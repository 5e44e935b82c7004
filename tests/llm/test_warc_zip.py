import base64
import gzip
import hashlib
import io
import zipfile
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from certflow.llm import warc_zip
from certflow.llm.warc_zip import archive_members, members_of, planned, read_records, record, split_records, write_archives
from certflow.session import scratch_dir

PAGES = [
    (3, "http://a/", "<p>same é</p>", 1), (1, "http://b/\r\nX: y", "<p>same é</p>", 1), (2, None, "<p>same é</p>", 1),
    (4, "http://c/", None, 1), (5, "http://d/", "", 1), (6, "http://e/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\n\n", 1),
    (None, "http://f/", "<p>same é</p>", 1), (7, "http://g/", "x" * 200_000, 1), (8, "http://h/", "lone", 1), (8, "http://h/", "lone", 1),
]
SCHEMA = "page_id long, url string, html string, payload int"


def want():
    first = {}
    for i, _, h, _ in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h, _ in PAGES:
        data = (h or "").encode()
        other = first.get(h or "") if i is not None and first.get(h or "") != i else None
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if other is not None else "response", other))
    return sorted(out, key=repr)


@pytest.mark.parametrize("zip64", [False, True])
def test_round_trip(spark, zip64, monkeypatch):
    folder = scratch_dir(spark, "warc")
    frame = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    write_archives(planned(frame), folder, zip64=zip64)
    monkeypatch.setattr(warc_zip, "RUN_BYTES", 100)  # index lines cross the borders of ranges
    rows = read_records(spark, folder)
    made = rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, made), key=repr) == want()
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in rows.where("record_type = 'response'").collect()}
    assert payloads[7] == "x" * 200_000 and payloads[6] == PAGES[5][2] and payloads[4] == ""
    members = archive_members(spark, folder).collect()
    assert {m["name"] for m in members} == {"archive/data.warc", "indexes/index.cdx"} and all(m["stored"] for m in members)
    for path in {m["path"] for m in members}:
        with zipfile.ZipFile(urlsplit(path).path) as z:
            assert z.testzip() is None
            for m in (m for m in members if m["path"] == path):
                assert z.getinfo(m["name"]).file_size == m["size"]


def test_small_payloads_are_not_deduplicated(spark):
    frame = spark.createDataFrame(PAGES, SCHEMA)
    assert {r["page_id"] for r in planned(frame, least_bytes=6).where("refers_to is not null").collect()} == {2, 3}


def test_foreign_archive_with_comment_and_packed_member():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("archive/one.warc.gz", gzip.compress(b"abc"), zipfile.ZIP_STORED)
        z.writestr("pages.txt", "hello " * 50, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\5\6 in a comment"
    data = raw.getvalue()
    found = members_of(lambda at, n: data[at:at + n], len(data))
    assert [(m["name"], m["method"]) for m in found] == [("archive/one.warc.gz", 0), ("pages.txt", 8)]
    assert gzip.decompress(data[found[0]["offset"]:found[0]["offset"] + found[0]["size"]]) == b"abc"


def test_gzip_records_are_split():
    records = [record(k, "http://x/", b"p" * k, k, "D", None) for k in range(3)]
    assert list(split_records(b"".join(map(gzip.compress, records)))) == records == list(split_records(b"".join(records)))


def warc(ids, pack=bytes):
    """Member and (offset, length) of its records, a warcinfo record first."""
    made = [b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 3\r\n\r\na:b\r\n\r\n"]
    made += [record(k, f"http://{k}/", b"p" * k, k, warc_zip._digest(b"p" * k), None) for k in ids]
    made = [pack(x) for x in made]
    return b"".join(made), [(sum(map(len, made[:k])), len(x)) for k, x in enumerate(made)]


def zipped(folder, members, method=zipfile.ZIP_STORED, file="one.zip"):
    with zipfile.ZipFile(folder / file, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return f"file://{folder}"


(A, AT_A), (B, AT_B), (C, AT_C) = warc([1, 2]), warc([3, 4, 5]), warc([6, 7], gzip.compress)
plain = lambda at: b"".join(b"x %d %d\n" % x for x in at)
named = lambda name, at: b"".join(b'k 2025 {"filename": "%s", "offset": "%d", "length": "%d"}\n' % (name, *x) for x in at)
cdx = lambda name, at: b"".join(b"k 2025 u text/html 200 D - - %d %d %s\n" % (n, x, name) for x, n in at)


@pytest.mark.parametrize("indexes", [
    {}, {"indexes/a.cdx": plain(AT_A), "indexes/b.cdx": plain(AT_B), "indexes/c.cdx": plain(AT_C)},
    {"indexes/index.cdxj": named(b"b.warc", AT_B) + named(b"a.warc", AT_A) + named(b"c.warc.gz", AT_C)},
    {"indexes/index.cdx": b" CDX N b a m s k r M S V g\n" + cdx(b"archive/c.warc.gz", AT_C) + cdx(b"a.warc", AT_A)},
    {"indexes/index.cdx": plain(AT_A)}, {"indexes/a.cdx": plain(AT_A), "indexes/again.cdxj": named(b"a.warc", AT_A)},
    {"indexes/b.cdx": plain([AT_B[0], AT_B[1], AT_B[1], AT_B[3]])}, {"indexes/index.cdx.gz": gzip.compress(plain(AT_A))},
], ids=["none", "each", "cdxj", "cdx", "nameless", "twice", "line-lost", "packed-inside"])
def test_every_archive_of_a_package_is_read(spark, tmp_path, indexes):
    folder = zipped(tmp_path, {"archive/a.warc": A, "archive/b.warc": B, "archive/c.warc.gz": C, **indexes})
    rows = read_records(spark, folder).select("page_id", "payload_bytes").collect()
    assert sorted(map(tuple, rows)) == [(k, k) for k in range(1, 8)]


def test_named_indexes_are_used(spark, tmp_path):
    folder = zipped(tmp_path, {"archive/a.warc": A, "archive/b.warc": B, "indexes/i.cdxj": named(b"a.warc", AT_A) + named(b"b.warc", AT_B)})
    ranges = warc_zip.record_ranges(archive_members(spark, folder)).collect()
    assert sum(r["size"] for r in ranges) == len(A) + len(B)
    assert warc_zip.index_entry(b"com,a)/ 2025 u text/html 200 D - - 7 9 a.warc.gz") == ("a.warc.gz", 9, 7)
    assert warc_zip.index_entry(b" CDX N b a m s k r M S V g") is None


def test_packed_members_and_packages_without_archive_are_errors(spark, tmp_path):
    for k, (members, method, says) in enumerate([
            ({"archive/a.warc": A, "indexes/a.cdx": plain(AT_A)}, zipfile.ZIP_DEFLATED, "packed member"),
            ({"pages.txt": b"x"}, zipfile.ZIP_STORED, "no archive member"),
            ({"archive/a.warc": b"x" * 50}, zipfile.ZIP_STORED, "no record begins")]):
        (tmp_path / str(k)).mkdir()
        folder = zipped(tmp_path / str(k), members, method)
        with pytest.raises(Exception, match=says):
            read_records(spark, folder).collect()


def test_damage_is_seen():
    one = record(1, "u", b"abc", 3, warc_zip._digest(b"abc"), None)
    with pytest.raises(ValueError, match="damaged"):
        warc_zip.parsed(one.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="not a ZIP"):
        members_of(lambda at, n: (b"x" * 100)[at:at + n], 100)


def test_empty_table(spark):
    folder = scratch_dir(spark, "warc")
    write_archives(planned(spark.createDataFrame([], SCHEMA)), folder)
    assert read_records(spark, folder).collect() == []


def test_reading_tasks_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "READ_BYTES", 250_000)
    folder = scratch_dir(spark, "warc")
    frame = spark.range(400).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "concat(id, repeat('y', 20000)) AS html").repartition(200)
    write_archives(planned(frame), folder)  # 200 ranges of 40 kB in 200 files
    rows = read_records(spark, folder)
    read = rows.select("page_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.page_id for r in read) == list(range(400)) and len({r.task for r in read}) > 20
    assert 400 * 20_000 // 250_000 < rows.rdd.getNumPartitions() < 45
