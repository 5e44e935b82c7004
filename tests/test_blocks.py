import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from certflow.sources import blocks
from certflow.sources.blocks import INSIDE, OUTSIDE, chunks_of, fields_of, grammar, records_of
from certflow.sources.landing import dialects_of, land_chunks, probe, scan

COLUMNS = ["Attestnummer", "GateAdresse", "Poststed"]


def made_rows(n, seed, quotes=0.5):
    rng = random.Random(seed)
    values = ["plain", "", "two\nlines", 'a "b" c', "a,b", "\n\n", "x" * 50, 'ends"', '"begins', "é\r\nø", ",\"\n,", "a;b\tc"]
    cell = lambda: rng.choice(values) if rng.random() < quotes else f"v{rng.randrange(1000)}"
    return [(f"A{k}", cell(), cell()) for k in range(n)]


def written(rows, separator=",", encoding="utf-8", end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=separator, lineterminator=end).writerows([COLUMNS, *rows])
    return out.getvalue().encode(encoding)


def wanted(rows):
    return sorted(tuple(c or None for c in r) for r in rows)


@pytest.fixture
def small(monkeypatch, spark):
    monkeypatch.setattr(blocks, "CHUNK_BYTES", 200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, path, folder):
    chunks = land_chunks(spark, str(path), folder)
    return records_of(chunks, dialects_of(chunks))


@pytest.mark.parametrize("separator, encoding, end", [(",", "utf-8", "\n"), (";", "latin-1", "\r\n"), ("\t", "utf-8-sig", "\n")])
def test_one_file_over_many_splits(spark, small, tmp_path, root, separator, encoding, end):
    rows = made_rows(3000, 1)
    (tmp_path / "enova_data_2020.csv").write_bytes(written(rows, separator, encoding, end))
    found = chunks_of(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() >= 8
    assert found.select("block").distinct().count() >= 8
    made = read(spark, tmp_path, f"{root}/chunks")
    assert sorted(((r.Attestnummer, r.GateAdresse, r.Poststed) for r in made.collect()), key=str) == sorted(wanted(rows), key=str)
    assert made.where("overflow IS NOT NULL OR unclosed OR NOT keyed").count() == 0
    # places in the file follow the records
    order = [r.Attestnummer for r in made.orderBy("source_block", "source_row").collect()]
    assert order == [r[0] for r in rows]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_record_over_several_splits(spark, small, tmp_path, root):
    long = "\n".join(f"line {k}, \"quoted\"" for k in range(2000))
    rows = [("A1", "x", ""), ("A2", long, "y"), ("A3", "two\nlines", long), ("A4", "", "end")]
    (tmp_path / "enova_data_2020.csv").write_bytes(written(rows))
    assert chunks_of(spark, str(tmp_path)).rdd.getNumPartitions() >= 8
    assert sorted((r.Attestnummer, r.GateAdresse, r.Poststed) for r in read(spark, tmp_path, f"{root}/c").collect()) == wanted(rows)


def test_dialects_equal_those_of_the_probe(spark, small, tmp_path, root):
    (tmp_path / "enova_data_2020.csv").write_bytes(written(made_rows(300, 2)))
    (tmp_path / "enova_data_2021.csv").write_bytes(written(made_rows(300, 3, 0), ";", "latin-1"))
    (tmp_path / "enova_data_2022.csv").write_bytes("Attestnummer;Poststed\nå;ø\n\n  \nb;c\n".encode("latin-1"))
    (tmp_path / "enova_data_2023.csv").write_bytes(b"\n\nfoo,bar\n1,rom 5\" vei\n")
    (tmp_path / "enova_data_2024.csv").write_bytes(b"")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(dialects_of(land_chunks(spark, str(tmp_path), f"{root}/c"))) == key(probe(spark, str(tmp_path)))
    scanned = scan(spark, probe(spark, str(tmp_path)))
    assert dict(scanned.groupBy("year").count().collect()) == {2020: 300, 2021: 300, 2022: 2}


def test_years_are_chosen_before_files_are_opened(spark, tmp_path, root):
    for year in (2019, 2020, 2021):
        (tmp_path / f"enova_data_{year}.csv").write_bytes(written(made_rows(3, year)))
    chunks = land_chunks(spark, str(tmp_path), f"{root}/c", (2020, 2021))
    assert sorted(r[0][-8:-4] for r in chunks.select("path").collect()) == ["2020", "2021"]


def test_odd_records(spark, tmp_path, root):
    text = ('Attestnummer,GateAdresse,Poststed\n' + 'A0,b,c\n' * 5 + 'A1,"a"b,c\nA2,5" rør,"x"\nA3\nA4,b,c,d,e\n   \n\nA5,"lone\rcr",b\rc\nA6,"never closed\nA7,x,y\n')
    (tmp_path / "enova_data_2020.csv").write_bytes(text.encode())
    got = {r.Attestnummer: (r.GateAdresse, r.Poststed, r.overflow, r.unclosed) for r in read(spark, tmp_path, f"{root}/c").collect()}
    assert got.pop("A0") == ("b", "c", None, False)
    assert got == {"A1": ("ab", "c", None, False), "A2": ('5" rør', "x", None, False), "A3": (None, None, None, False), "A4": ("b", "c", "d", False),
                   "A5": ("lone\rcr", "b\rc", None, False), "A6": ("never closed\nA7,x,y", None, None, True)}


def test_no_known_column_and_no_file(spark, tmp_path, root):
    (tmp_path / "enova_data_2020.csv").write_bytes(b"foo,bar\n1,2\n")
    with pytest.raises(ValueError, match="expected"):
        read(spark, tmp_path, f"{root}/c")


def test_many_files_in_one_read(spark, tmp_path, root):
    for k in range(400):
        # every second file has a header of its own
        extra = f",X{k}" if k % 2 else ""
        (tmp_path / f"enova_data_{k:04}.csv").write_text(f"Attestnummer,Knr{extra}\nA{k},{k}\n")
    made = read(spark, tmp_path, f"{root}/c")
    assert made.count() == 400 and made.agg(F.sum(F.col("Knr").cast("int"))).first()[0] == sum(range(400))
    assert made._jdf.queryExecution().analyzed().toString().count("Relation") < 20  # no read or union arm per header


@pytest.mark.parametrize("separator", [",", ";", "\t"])
def test_states_by_brute_force(separator):
    def state_after(data, state):
        fresh, after_quote = True, False
        for c in data:
            if state == INSIDE:
                if after_quote:
                    after_quote = False
                    if c == '"':
                        continue
                    state = OUTSIDE
                elif c == '"':
                    after_quote = True
                    continue
                else:
                    continue
            if c == '"' and fresh:
                state = INSIDE
            fresh = c in (separator, "\n")
        return OUTSIDE if state == OUTSIDE or after_quote else INSIDE

    rng = random.Random(5)
    for _ in range(3000):
        data = "".join(rng.choice('a"\n,;\t') for _ in range(rng.randrange(12))) + "\n"
        for state in (OUTSIDE, INSIDE):
            got = grammar(separator).after(b"\n" + data.encode(), state)
            assert got == state_after(data, state), (data, state)


def test_fields_equal_the_csv_module():
    rng = random.Random(6)
    for _ in range(2000):
        row = ["".join(rng.choice('ab" ,;\n') for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 5))]
        out = io.StringIO(newline="")
        csv.writer(out).writerow(row)
        assert fields_of(out.getvalue().removesuffix("\r\n"), ",") == row
