import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from certflow.plans import jobs
from certflow.schemas import IMPORTED, QUARANTINE
from certflow.sources import tables as T
from certflow.sources.buckets import merge_buckets, purge_buckets, read_buckets, write_buckets
from certflow.sources.files import changed_files, entries, list_files, list_tree, scan_manifest
from certflow.sources.tables import append_batch, drop_folded, fold_batches, read_batches, read_log
from certflow.streaming import import_available, import_epoch


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def held(spark, root, skip=None):
    return sorted(r.n for r in read_batches(spark, root, "t", numbers(spark).schema, skip).collect())


def test_log_folds_and_repeated_batches(spark, root):
    schema = numbers(spark).schema
    assert held(spark, root) == [] and fold_batches(spark, root, "t", schema, least=0) == 0
    for k in range(5):
        append_batch(numbers(spark, k, k), root, "t", f"b {k}")
    assert held(spark, root) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4] and held(spark, root, "b 2") == [0, 0, 1, 1, 3, 3, 4, 4]
    assert fold_batches(spark, root, "t", schema, least=6) == 0
    assert fold_batches(spark, root, "t", schema, least=5) == 5
    assert held(spark, root) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4] and held(spark, root, "b 2") == [0, 0, 1, 1, 3, 3, 4, 4]
    append_batch(numbers(spark, 20), root, "t", "b 2")  # a folded batch runs again
    append_batch(numbers(spark, 5), root, "t", "b 5")
    assert held(spark, root) == [0, 0, 1, 1, 3, 3, 4, 4, 5, 20] and held(spark, root, "b 2") == [0, 0, 1, 1, 3, 3, 4, 4, 5]
    assert fold_batches(spark, root, "t", schema, least=2) == 2
    assert drop_folded(spark, root, "t") == 6  # b 0 to b 4, and b 5
    assert held(spark, root) == [0, 0, 1, 1, 3, 3, 4, 4, 5, 20]
    append_batch(numbers(spark, 21), root, "t", "b 2")
    assert held(spark, root) == [0, 0, 1, 1, 3, 3, 4, 4, 5, 21]


def test_a_thousand_batches(spark, root):
    schema = numbers(spark).schema
    path = f"{root}/t".removeprefix("file:")
    for k in range(1000):
        os.makedirs(f"{path}/batch=b{k:04}")
        pq.write_table(pa.table({"n": [k]}), f"{path}/batch=b{k:04}/part-0.parquet")
    T._change(spark, path, lambda e: [{"folder": f"batch=b{k:04}", "batches": [f"b{k:04}"], "without": []} for k in range(1000)])
    assert held(spark, path.removesuffix("/t")) == list(range(1000))
    assert fold_batches(spark, path.removesuffix("/t"), "t", schema) == 1000 and drop_folded(spark, path.removesuffix("/t"), "t") == 1000
    assert held(spark, path.removesuffix("/t"), "b0500") == [k for k in range(1000) if k != 500]
    assert len(read_log(spark, path)[1]) == 1
    for k in range(15):
        T._change(spark, path, lambda e: e)
    assert len(T._log_files(spark, path)) == T.KEPT_LOGS


def test_two_writers(spark, root, monkeypatch):
    append_batch(numbers(spark, 1), root, "t", "b1")
    before = T.read_log
    late = iter([True])

    def stale(spark_, table):
        found = before(spark_, table)
        if next(late, False):  # another writer commits between reading and writing
            append_batch(numbers(spark, 2), root, "t", "b2")
        return found

    monkeypatch.setattr(T, "read_log", stale)
    append_batch(numbers(spark, 3), root, "t", "b3")
    assert held(spark, root) == [1, 2, 3]


def test_a_table_from_before_the_log(spark, root):
    for k in (1, 2):
        numbers(spark, k).write.parquet(f"{root}/t/batch=b{k}")
    append_batch(numbers(spark, 3), root, "t", "b3")
    assert held(spark, root) == [1, 2, 3]


def files_of(root, table, n):
    top = f"{root}/{table}/buckets={n}".removeprefix("file:")
    return {d: sorted(x for x in os.listdir(f"{top}/{d}") if x.endswith(".parquet")) for d in os.listdir(top) if "=" in d}


def test_only_touched_buckets_are_rewritten(spark, root):
    rows = spark.range(2000).selectExpr("id AS k", "'old' AS v", "0 AS t").unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS k, 'null' AS v, 0 AS t"))
    write_buckets(rows, root, "t", ["k"], 16)
    before = files_of(root, "t", 16)
    assert len(before) == 16
    change = spark.createDataFrame([(5, "new", 1), (5, "newer", 2), (5000, "added", 1), (None, "null again", 1)], "k long, v string, t int")
    touched = {r.bucket: r["rows"] for r in merge_buckets(change, root, "t", rows.schema, ["k"], [F.desc("t")], "b1").collect()}
    after = files_of(root, "t", 16)
    assert 0 < len(touched) <= 3
    assert {d for d in before if before[d] != after[d]} == {f"_bucket={b}" for b in touched}
    wanted = {(k, "old") for k in range(2000) if k != 5} | {(5, "newer"), (5000, "added"), (None, "null again")}
    got = read_buckets(spark, root, "t", rows.schema)
    assert {(r.k, r.v) for r in got.collect()} == wanted and got.count() == 2002
    merge_buckets(change, root, "t", rows.schema, ["k"], [F.desc("t")], "b1")  # the batch runs again
    again = read_buckets(spark, root, "t", rows.schema)
    assert {(r.k, r.v) for r in again.collect()} == wanted and again.count() == 2002
    merge_buckets(change.limit(0), root, "t", rows.schema, ["k"], [F.desc("t")], "b2")
    with pytest.raises(ValueError, match="older"):
        merge_buckets(change, root, "t", rows.schema, ["k"], [F.desc("t")], "b0")
    plan = read_buckets(spark, root, "t", rows.schema, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan
    assert purge_buckets(spark, root, "t", rows.schema, ["k"], spark.range(5, 6).withColumnRenamed("id", "k")) == 1
    assert {r.k for r in read_buckets(spark, root, "t", rows.schema).collect()} == {k for k, _ in wanted} - {5}
    everything = read_buckets(spark, root, "t", rows.schema).select("k")
    assert purge_buckets(spark, root, "t", rows.schema, ["k"], everything) == 16
    assert read_buckets(spark, root, "t", rows.schema).count() == 0


def test_merge_without_a_table(spark, root):
    with pytest.raises(ValueError, match="no bucketed table"):
        merge_buckets(numbers(spark, 1), root, "t", numbers(spark).schema, ["n"], [], "b1")


@pytest.fixture
def tree(tmp_path):
    for name in ("a.pdf", "sub/b.PDF", "sub/deep/er/c d.pdf", "sub/å.pdf", "t.txt", "none", "_hidden/x.pdf", "sub/_x.pdf", ".y.pdf", "k=1/_z=2/w.pdf", "empty/"):
        place = tmp_path / "in" / name
        place.mkdir(parents=True) if name.endswith("/") else place.parent.mkdir(parents=True, exist_ok=True)
        if not name.endswith("/"):
            place.write_bytes(name.encode())
    return tmp_path / "in"


@pytest.mark.parametrize("glob", [None, "*.[pP][dD][fF]", "*.txt"])
def test_tree_equals_sparks_listing(spark, tree, root, glob):
    columns = ["filename", "full_path", "file_size", "file_extension", "modified"]
    key = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    for top in (str(tree), f"file://{tree}"):
        assert key(list_tree(spark, [top], f"{root}/levels{len(top)}", glob, folders_per_task=1)) == key(list_files(spark, str(tree), glob))
    assert list_tree(spark, [f"{tree}/not there"], f"{root}/none", glob).collect() == []


def test_manifest_changes(spark, tree, root):
    assert {r.change for r in scan_manifest(spark, [str(tree)], root, "b1").collect()} == {"added"}
    (tree / "a.pdf").unlink()
    (tree / "sub" / "b.PDF").write_bytes(b"longer than before")
    (tree / "new.pdf").write_bytes(b"x")
    for _ in range(2):
        got = {(r.full_path.rsplit("/", 1)[1], r.change, r.old_size, r.new_size) for r in scan_manifest(spark, [str(tree)], root, "b2").collect()}
        assert got == {("a.pdf", "removed", 5, None), ("b.PDF", "changed", 9, 18), ("new.pdf", "added", None, 1)}
    listing = list_files(spark, str(tree))
    assert changed_files(listing, listing).count() == 0
    assert all(isinstance(x[3], int) for x in entries(str(tree)))


def write_year(folder, year, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"enova_data_{year}.csv").write_text("Attestnummer,Knr\n" + "".join(f"{k},{v}\n" for k, v in rows))


def test_stream_of_landed_files(spark, tmp_path, root):
    landed = tmp_path / "in"
    write_year(landed, 2020, [("A1", 1), ("A2", 2)])
    write_year(landed, 2021, [("A2", 9), ("A3", 3)])
    keys = lambda: sorted((r.Attestnummer, r.Knr) for r in read_batches(spark, root, "imported", IMPORTED).collect())
    assert import_available(spark, str(landed), root, files_per_batch=1) == 2
    first = keys()
    assert [k for k, _ in first] == ["A1", "A2", "A3"]
    assert import_available(spark, str(landed), root) == 0 and keys() == first
    write_year(landed, 2022, [("A3", 7), ("A4", 4)])
    assert import_available(spark, str(landed), root) == 1
    whole = keys()
    assert whole == sorted([*first, ("A4", 4.0)])
    for epoch in (1, 0):  # batches that are handed out again
        import_epoch(spark.read.parquet(f"{root}/stream_files/batch=stream-{epoch:012}"), epoch, root)
        assert keys() == whole


def test_quarantine(spark, tmp_path, root):
    (tmp_path / "enova_data_2020.csv").write_text("Attestnummer,Knr\n" + "".join(f"A{k},{k}\n" for k in range(6)) + 'B,1,2,3\nC,4\nD,"5\n')
    for _ in range(2):
        report = jobs.import_certificates(spark, str(tmp_path), root, "b1").head()
    assert (report.total_rows, report.inserted_rows, report.failed_rows) == (9, 7, 2)
    rows = read_batches(spark, root, "quarantine", QUARANTINE).orderBy("source_row").collect()
    assert [(r.year, r.reason, r.record) for r in rows] == [
        (2020, "more fields than the header", '{"Knr":"1","Attestnummer":"B","overflow":"2"}'),
        (2020, "quote without an end", '{"Knr":"5","Attestnummer":"D"}')]
    assert rows[0].source_path.endswith("enova_data_2020.csv")
