import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from certflow.llm.quality import clean_documents, judge_quality, line_failure, measure, repeated_words


@pytest.mark.parametrize(("line", "rule"), [
    ("A plain sentence, with a comma.", None), ("Es.", None), ("Wait...", None), ('He said "no"', None),
    ("No end of sentence", "punctuation"), ("HE!! RAN!! AND!! ATE!!", "punctuation"), ("word### more$$$ of*** it.", "punctuation"),
    ("home | about | contact | news.", "navigation"), ("Please accept our Cookie notice.", "boilerplate"),
    ("First. Then a line that ends at a number 17", None),
])
def test_lines(line, rule):
    assert line_failure(line, len(line.split()), 3, 1) == rule


FRENCH = "« Oui », dit-il. « Non », dit-elle. « Peut-être », dit l'autre, et « jamais » fut le mot de la fin."


@pytest.mark.parametrize(("line", "rule"), [
    (FRENCH, None), (" ".join([FRENCH] * 40), None), ("»Ja«, sagte er. »Nein«, sagte sie. »Doch«, riefen alle.", None),
    ("«Sí», dijo ‹él›. «No», dijo ‹ella›.", None), ("The <b>bold</b> and the <i>slanted</i> words of this text all stand in one line.", None),
    ("These ten words of prose stand around one | bar only. " * 9, None),
    ("Home » News » Sports » Results.", "navigation"), ("Home > News > Sports > Results.", "navigation"),
    ("one › two › three › four.", "navigation"), ("home | about us | all of the latest news. " * 30, "navigation"),
])
def test_quotations_and_long_lines_are_no_menus(line, rule):
    assert line_failure(line, len(line.split()), 3, 1) == rule


def test_quoted_prose_in_one_line_stays_whole():
    text = "« Oui », dit-il en riant. « Non », dit-elle sans le regarder une seule fois."
    assert measure(text, 40, 3, 1)[-3:] == (0, True, text)


@pytest.mark.parametrize(("line", "rule"), [
    ("She found a flaw of design in it.", None), ("The catalog in the hall is old.", None), ("He wrote his blog in May.", None),
    ("Bake the cookie until its edges are brown, and let it cool on a rack.", None),
    ("A long line of plain words in which nothing at all is wrong. " * 50 + "Then she had to log in.", None),
    ("Sign in or log in.", "boilerplate"), ("We use cookies. Read our privacy policy.", "boilerplate"),
    ("Click here to unsubscribe from this list.", "boilerplate"), ("© 2020 Some Firm. All rights reserved.", "boilerplate"),
    ("Read more. Click here. Powered by us. " * 50, "boilerplate"),
])
def test_boilerplate_is_a_share_of_whole_words(line, rule):
    assert line_failure(line, len(line.split()), 3, 1) == rule


def test_long_clean_line_with_one_phrase_stays_whole():
    text = " ".join(f"word{k}" for k in range(500)) + " is what the privacy policy of a shop once said."
    assert measure(text, 40, 3, 1)[-3:] == (0, True, text)


def brute(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words(words):
    assert repeated_words(words) == brute(words)


def test_repeated_words_of_a_large_vocabulary():
    words = [f"w{k}" for k in range(7000)]
    assert repeated_words(words + words[10:16]) == 12
    assert repeated_words(words) == 0


GOOD = "This is a line of ten good words that all count.\n" * 1 + "Another line follows here, and it is fine.\nAnd so on."


def test_rows(spark):
    half = GOOD + "\n" + "menu | of | many | short | parts | and | more | of | them | and | on | and | on | it | goes"
    docs = [(1, GOOD), (2, None), (3, ""), (4, "\n \n"), (5, half * 2), (None, GOOD), (1, GOOD), (6, "word " * 100)]
    frame = spark.createDataFrame([(i, t, "own", 5) for i, t in docs], "doc_id long, text string, kept string, n_chars int")
    rows = judge_quality(frame).collect()
    assert len(rows) == len(docs)
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False, None: True, 6: False}
    made = clean_documents(frame)
    assert made.columns == frame.columns and made.schema == frame.schema
    assert sorted((r["doc_id"] or 0, r["text"], r["kept"], r["n_chars"]) for r in made.collect()) == [
        (0, GOOD, "own", len(GOOD)), (1, GOOD, "own", len(GOOD)), (1, GOOD, "own", len(GOOD))]


def test_failed_lines_leave_the_text():
    text = GOOD + "\nhome | news | about | us"
    assert measure(text, 40, 3, 1)[-2:] == (True, GOOD)


def test_clean_documents_stay(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = judge_quality(frame).join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert good.count() > 200 and good.where("not kept").count() == 0
    bad = judge_quality(frame).join(labels, "doc_id").where("quality = 0")
    assert bad.count() > 40 and bad.where("kept").count() == 0


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert judge_quality(frame).collect() == [] and clean_documents(frame).collect() == []
