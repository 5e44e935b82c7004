import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from certflow.llm.collocations import collocations
from certflow.llm.keyfilter import key_filter, may_hold

SCHEMA = "doc_id long, text string, lang string, a string, prefix string, n string, words string, total string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "a", "p", "n", "w", "t") for k, (lang, t) in enumerate(rows)], SCHEMA)


def brute(rows, min_count, longest=5, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    made = {}
    for (lang, p), a in often.items():
        inside = any(b >= a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for (other, q), b in often.items() if other == lang)
        if not inside:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            made.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [(lang, rank, p.decode(), -a, l, r, n[lang], -score)
            for lang in made for rank, (score, a, p, l, r) in enumerate(sorted(made[lang])[:top], 1)]


def found(spark, rows, min_count, **args):
    made = collocations(frame(spark, rows).repartition(3), min_count=min_count, **args)
    assert [f.simpleString() for f in made.schema] == [
        "lang:string", "rank:bigint", "phrase:string", "a:bigint", "l:bigint", "r:bigint", "n:bigint", "score:bigint"]
    return sorted(map(tuple, made.collect()))


ROWS = [
    ("en", "New York is big. new york, New York! In New York City Hall we met\nin new york city hall we met"),
    ("en", "a a a a a a\ta a. b a b a b a: in New York City Hall"), ("en", None), ("en", ""), ("en", " . ,;\t \n\r\x0b\x0c"),
    (None, "la la land la la land é É é É \x00 x\x00y x\x00y"), ("und", "la la land"), ("xx", "once only words here"),
    ("", "no tongue no tongue no tongue"), ("de", "ß ß ß ß ß ß. ABC abc ABC abc"),
] * 2


@pytest.mark.parametrize("min_count", [1, 2, 3, 4, 7])
def test_equals_brute_force(spark, min_count):
    assert found(spark, ROWS, min_count) == sorted(brute(ROWS, min_count))


def test_small_chunks_slices_and_a_full_filter(spark):
    expected = sorted(brute(ROWS, 2))
    assert found(spark, ROWS, 2, chunk=5, slices=1) == expected
    assert found(spark, ROWS, 2, chunk=40, slices=30, filter_bits=6) == expected


def test_long_text_and_a_stripe_over_many_rows(spark):
    long = " ".join(f"the w{k % 700} of" for k in range(60_000))
    rows = [("en", long), ("en", "the w1 of the w2 of")]
    assert found(spark, rows, 50, chunk=1000) == sorted(brute(rows, 50))


def test_top_and_ties(spark):
    rows = [("en", f"{a} {b}") for a, b in ("xz", "xy", "xa", "ßa", "Za")] * 2
    assert found(spark, rows, 2, top=3) == sorted(brute(rows, 2, top=3))


def test_empty_table(spark):
    assert found(spark, [], 1) == []


def test_key_filter(spark):
    import numpy as np

    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5000)
    table = key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key", 20)
    assert may_hold(table, keys.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 20000).view(np.uint64)
    assert may_hold(table, other).mean() < 0.01
    assert not may_hold(key_filter(spark.range(0).select(F.col("id").alias("key")), "key", 10), other).any()
