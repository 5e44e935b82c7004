import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from certflow.llm.language_id import Scorer, gram_hashes, identify, predict, train, training_rows, words_of


def test_words():
    assert words_of("Où est-ce 12 x²y _z_ Ωμ") == ["où", "est", "ce", "x", "y", "z", "ωμ"]
    assert words_of(None) == words_of("12 3.4 !") == []


def test_gram_hashes_follow_their_characters():
    grams, contexts, owner = gram_hashes(["abab", "ab"], 3)
    assert owner.tolist() == [0] * 5 + [1] * 3
    assert grams[1][1] == grams[1][3] == grams[1][6] and grams[1][0] != grams[1][2]
    assert np.array_equal(contexts[2][1:5], grams[1][0:4])


def kneser_ney(words, order):
    """Interpolated Kneser-Ney in plain dictionaries."""
    grams = Counter()
    for w, c in words.items():
        padded = "\x02" * (order - 1) + w + "\x03"
        for k in range(order - 1, len(padded)):
            grams[padded[k - order + 1:k + 1]] += c
    levels = {order: grams}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(levels[1]) + 1)
        level = levels[n]
        ones, twos = (sum(c == k for c in level.values()) for k in (1, 2))
        d = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        seen = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        if not seen:
            return p(gram[1:])
        return max(level[gram] - d, 0) / sum(seen.values()) + d * len(seen) / sum(seen.values()) * p(gram[1:])

    return p


def test_model_equals_plain_dictionaries(spark):
    rng = random.Random(1)
    texts = {lang: [" ".join("".join(rng.choice(chars) for _ in range(rng.randrange(1, 6))) for _ in range(30)) for _ in range(20)]
             for lang, chars in (("aa", "abcde"), ("bb", "cdefg"))}
    rows = [(k * 2 + (lang == "bb"), lang, t) for lang, ts in texts.items() for k, t in enumerate(ts)]
    model = train(spark.createDataFrame(rows, "doc_id long, lang string, text string"), order=3, docs_per_lang=100)
    assert model.langs == ["aa", "bb"]
    words = ["abc", "zz", "cdg", "e"]
    got = model.word_scores(words)
    fits = lambda k: zlib.crc32(str(k).encode()) % 5 != 1
    for j, lang in enumerate(model.langs):
        p = kneser_ney(Counter(w for k, one, t in rows if one == lang and fits(k) for w in words_of(t)), 3)
        for i, w in enumerate(words):
            padded = "\x02\x02" + w + "\x03"
            assert got[i, j] == pytest.approx(sum(math.log(p(padded[k - 2:k + 1])) for k in range(2, len(padded))))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    right = [r["lang"] == r["lang_pred"] for r in made]
    assert len(right) > 150 and sum(right) / len(right) > 0.98
    assert all(0 <= r["score"] <= 1 for r in made)
    assert sum(not r["accepted"] for r in made) == 0


def edge_rows():
    rng = random.Random(2)
    word = lambda chars: "".join(rng.choice(chars) for _ in range(5))
    rows = [(k, " ".join(word("abcde") for _ in range(60)), "aa", "own") for k in range(60)]
    rows += [(100 + k, " ".join(word("vwxyz") for _ in range(60)), "bb", "own") for k in range(60)]
    return rows + [(500, None, "aa", None), (501, "", "aa", None), (502, "12 %&", None, None), (None, rows[0][1], "aa", None),
                   (503, rows[0][1], None, None), (503, rows[0][1], None, None), (504, "ЖЩЮ ЯЖЩ " * 50, None, None)]


def test_rejection_and_edges(spark):
    frame = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, score string")
    rows = predict(frame, train(training_rows(frame))).collect()
    assert len(rows) == len(edge_rows())
    by = {r["doc_id"]: r for r in rows}
    assert [by[k]["lang_pred"] for k in (500, 501, 502, 503, None, 130)] == ["und", "und", "und", "aa", "aa", "bb"]
    assert not by[504]["accepted"] and not by[502]["accepted"] and by[503]["accepted"]
    assert all(r["accepted"] for r in rows if r["doc_id"] is not None and r["doc_id"] < 200)


def test_nothing_learned(spark):
    frame = spark.createDataFrame([(1, "some words", None), (2, "12", None)], "doc_id long, text string, lang string")
    rows = sorted(identify(frame).collect())
    assert [(r["lang_pred"], r["score"], r["accepted"]) for r in rows] == [("und", 0.0, True), ("und", 0.0, False)]
    assert identify(frame.limit(0)).collect() == []


def test_cache_is_bounded(spark, monkeypatch):
    from certflow.llm import language_id

    frame = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, score string")
    model = train(training_rows(frame))
    texts = [r[1] for r in edge_rows()]
    want = Scorer(model).entropies(texts)
    monkeypatch.setattr(language_id, "WORD_CACHE", 7)
    scorer = Scorer(model)
    for text, one in zip(texts, want):
        got = scorer.entropies([text])[0]
        assert (got is None) == (one is None) and (one is None or np.allclose(got[0], one[0]))
