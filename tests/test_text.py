import random
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from certflow.functions import text as X
from certflow.functions.answers import SECTIONS, fallback_sections, parse_answer, strip_markdown

LINES = [
    "12", "Page 3", "12/7", "---", "•▪", "© 2024 x", "DRAFT", "31-12-24", "http://a.b rest", "me@x.no tail", "see http://a.b",
    "hello  worldAgain.Next", "Ø ★ ok", "ab", "ﬁne ½ CO₂", "Åse", "", " ", "\t", " ★ ", "a - b", "Confidential \r", "a.b.c.d",
    "one two three four five six seven eight nine ten eleven", "one two three four five six seven eight nine ten twelve",
]


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(7)
    made = ["\n".join(rnd.choice(LINES) for _ in range(rnd.randint(0, 25))) for _ in range(500)]
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    return spark.createDataFrame(list(enumerate([*made, *real])), "i int, t string").repartition(8)


@pytest.mark.parametrize("aggressive", [False, True])
def test_cleaning_is_idempotent_on_its_own_output(spark, texts, aggressive):
    once = texts.select("i", X.clean_text(F.col("t"), aggressive).alias("c")).collect()
    # spaces put into words like a.b.c or aBc can make new matches, so texts with such are left out
    stable = [r for r in once if "." not in r.c and not re.search("[a-z][A-Z]", r.c)]
    again = spark.createDataFrame(stable, "i int, c string").select("c", X.clean_text(F.col("c"), aggressive).alias("d")).collect()
    assert len(stable) > 20 and [r for r in again if r.c != r.d] == []


def test_no_kept_line_is_an_artefact(texts):
    lines = texts.select(F.explode(F.split(X.clean_text(F.col("t")), "\n")).alias("line"))
    bad = lines.where(F.col("line").rlike(r"^(?i)(\s*(page\s+)?[0-9]+\s*|draft|confidential|[-_=]{3,}|https?://\S.*|©.*)$"))
    assert bad.count() == 0


def test_no_line_is_like_one_of_the_ten_before(texts):
    rows = texts.select(X.drop_repeated_lines(F.col("t")).alias("c")).collect()
    words = lambda x: set(x.lower().split())
    for r in rows:
        kept = [words(x) for x in r.c.split("\n") if x.strip()]
        for k, one in enumerate(kept):
            # blank lines take places among the ten as well, so the nine lines before are looked at only where none is blank
            near = kept[max(0, k - 10):k] if "\n\n" not in r.c else kept[max(0, k - 1):k]
            assert all(len(one & x) <= 0.9 * len(one | x) for x in near) or "\n\n" in r.c or "\n \n" in r.c or "\n\t\n" in r.c


def one(spark, column, *values):
    return spark.createDataFrame([values], ", ".join(f"v{i} string" for i in range(len(values)))).select(column.alias("c")).head().c


@pytest.mark.parametrize("line,result", [
    ("12", ""), ("Page 3", ""), ("---", ""), ("http://a.b rest", ""), ("see http://a.b", "see http://a. b"),
    ("hello  worldAgain.Next", "hello world Again. Next"), ("Ø ★ ok", "Ø ok"), ("ab", ""), ("ﬁne ½ CO₂", "fine 1⁄2 CO2"),
    ("Åse", "Åse"), ("abc\n\n\n\n\nxyz", "abc\n\nxyz"),
])
def test_line_rules(spark, line, result):
    assert one(spark, X.clean_text(F.col("v0")), line) == result


def test_decomposition_holds_few_texts_at_a_time(spark):
    made = [None, "", "plain", "ﬁne ½ CO₂", "Å" * 100_000, "A\u030a\u0327", "\U0001d400 \U0001f600 각", "\u212b\x00é"]
    rows = spark.createDataFrame(list(enumerate(made * 100)), "i int, t string").repartition(2).select("i", "t", X.nfkd(F.col("t")).alias("c"))
    for i, t, c in rows.collect():
        assert c == (None if t is None else unicodedata.normalize("NFKD", t)), i
    # an Arrow batch would be 10,000 texts, whatever their lengths
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_window_of_ten_kept_lines(spark):
    lines = ["a b c"] + [f"line {i}" for i in range(10)] + ["a b c"]
    assert one(spark, X.drop_repeated_lines(F.col("v0")), "\n".join(lines)) == "\n".join(lines)
    assert one(spark, X.drop_repeated_lines(F.col("v0")), "a b c\na b c\n\nx y\na b c") == "a b c\n\nx y"


def test_very_long_text(spark):
    lines = [f"row {i} of {i // 3 % 7}" if i % 5 else "same line" for i in range(30000)]
    kept = one(spark, X.drop_repeated_lines(F.col("v0")), "\n".join(lines)).split("\n")
    rows = [x for x in kept if x != "same line"]
    # "row i of n" shares at most 3 of 5 words with another row, so all rows stay, and one "same line" in each ten kept lines
    assert rows == [x for x in lines if x != "same line"]
    places = [k for k, x in enumerate(kept) if x == "same line"]
    assert places[0] == 0 and all(b - a > 10 for a, b in zip(places, places[1:]))


def test_blocks_of_more_than_twenty_characters(spark):
    assert one(spark, X.content_blocks(F.col("v0")), "twenty characters ok\n\n twenty-one characters \n \nshort") == ["twenty-one characters"]


@pytest.mark.parametrize("marked,plain_text", [
    ("**bold** and __strong__ `code`", "bold and strong code"), ("# Head\n- item\n12. next", "Head item next"), ("a *b* _c_", "a b c"),
])
def test_markdown(spark, marked, plain_text):
    assert one(spark, strip_markdown(F.col("v0")), marked) == plain_text


def test_long_answer_is_read_in_linear_time(spark):
    text = "Om eiendommen\n" + "\n".join(f"line {i}" for i in range(40_000))
    start = time.perf_counter()
    got = one(spark, fallback_sections(F.col("v0")), text)
    assert got["AboutEstate"].endswith("line 39999") and time.perf_counter() - start < 15


def test_extra_patterns_and_flags(spark):
    c = F.col("v0")
    assert one(spark, X.clean_lines(c, extra_patterns=["foo", r"bar\d"]), "Foo x\nkeep\n bar1\nabar1") == "keep\nabar1"
    assert one(spark, X.clean_lines(c, artefacts=False, headers=False), "Page 3\nDRAFT") == "Page 3\nDRAFT"
    assert one(spark, X.clean_lines(c, headers=False), "Page 3\nDRAFT") == "DRAFT"
    assert one(spark, X.clean_lines(c, preserve_structure=False), "abc\n\nxyz") == "abc\nxyz"
    assert one(spark, X.clean_lines(c), None) == ""


@pytest.mark.parametrize("answer,sections", [
    ("Eiendom: A **b** c\nd\n\nPositive ting: - x_y_ `z`\nKort vurdering: 1. ok # no", ["A b c d", "xy z", "ok # no"]),
    ("## **Eiendom:** foo\n**Positive ting:** bar\n**Kort vurdering:** baz", ["foo", "bar", "baz"]),
    ("Positive ting: only", ["Ikke tilgjengelig i responsen", "only", "Ikke tilgjengelig i responsen"]),
    ("EIENDOM:x positive ting:y KORT VURDERING:", ["x", "y", "Ikke tilgjengelig i responsen"]),
    ("Om eiendommen: a\nPositive forhold: b\nKonklusjon: c", ["a", "b", "c"]),
    ("intet her", ["intet her", "Ikke tilgjengelig i responsen", "Ikke tilgjengelig i responsen"]),
    ("Eiendom: " + "x" * 1990, ["x" * 1990] + ["Ikke tilgjengelig i responsen"] * 2),
    ("Eiendom: " + "x" * 1991, ["x" * 1987 + "..."] + ["Ikke tilgjengelig i responsen"] * 2),
])
def test_sections(spark, answer, sections):
    got = one(spark, parse_answer(F.col("v0")), answer)
    assert [got[s] for s in SECTIONS] == sections


@pytest.mark.parametrize("answer,sections", [
    ("lead\nPositive ting: x: y\nmore\nvurdering her", ["lead", "x: y more", ""]),
    ("Positive ting: a\nPositive forhold: b", ["", "b", ""]),           # a repeated header overwrites
    ("Positive ting: a\nPositive forhold:", ["", "a", ""]),              # but not with nothing
    ("lead\nOm eiendommen: x", ["x", "", ""]), ("", ["", "", ""]), ("Konklusjon\n\n c ", ["", "", "c"]),
])
def test_reading_by_lines(spark, answer, sections):
    got = one(spark, fallback_sections(F.col("v0")), answer)
    assert [got[s] for s in SECTIONS] == sections
