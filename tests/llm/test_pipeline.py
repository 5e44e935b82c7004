import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from certflow.llm import bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentences(seed, chars="abcdefgh", n=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(chars) for _ in range(rng.randrange(2, 8)))
    return "\n".join(" ".join(word() for _ in range(15)).capitalize() + "." for _ in range(n))


def docs():
    rows = [(k, sentences(k), "aa", f"s{k % 4}", 0) for k in range(120)]
    rows += [(200 + k, sentences(500 + k, "stuvwxyz"), "bb", None, 0) for k in range(80)]
    rows += [(400 + k, rows[7][1] + f" Added {k}.", "aa", "s0", 0) for k in range(5)]  # near copies
    rows += [(7, rows[7][1], "aa", "s0", 0), (500, None, None, None, None), (501, "", "aa", "s1", 0), (502, "too short", "aa", "s1", 0),
             (None, sentences(999), None, "s2", None)]
    return rows


def test_run(spark, tmp_path):
    folder = f"file://{tmp_path}"
    spark.createDataFrame(docs(), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        frame.write.parquet(f"{folder}/in-{name}")
        frame = stage(spark, spark.read.parquet(f"{folder}/in-{name}"), folder)
        made[name] = frame
        if name != "tokens":
            assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in spark.read.parquet(f"{folder}/documents.parquet").schema]
    ids = {name: sorted((r[0] for r in made[name].select("doc_id").collect()), key=repr) for name in made}
    clean = [k for k in range(120)] + [200 + k for k in range(80)]
    assert set(clean) | {400, 404, None} <= set(ids["quality_rules"]) and not {500, 501, 502} & set(ids["quality_rules"])
    assert ids["language"] == ids["quality_rules"]
    assert ids["near_duplicates"] == sorted([*clean, None], key=repr)
    assert set(ids["tokens"]) == set(ids["mixture"]) <= set(clean) | {None}
    model = bpe.tokenizer(corpus_pipeline.TOKENIZER_FILE)
    pieces = sorted(tuple(model.encode(r["text"], add_special_tokens=False).ids) for r in made["mixture"].collect())
    assert pieces == sorted(tuple(r["ids"]) for r in made["tokens"].collect())
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, made["tokens"].collect()))


def test_repeated_and_null_ids_keep_one_row_of_each_group(spark):
    one, two, three, four = map(sentences, range(4))
    rows = [(1, one, "aa", "s", 0), (5, one, "aa", "s", 0), (5, two, "aa", "s", 0), (5, three, "aa", "s", 0), (5, three, "aa", "s", 0),
            (None, three, "aa", "s", 0), (None, four, "aa", "s", 0), (None, four, "aa", "s", 0), (None, four + " Added.", "aa", "s", 0)]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        made = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
        found = [(r["doc_id"], r["text"].removesuffix(" Added.")) for r in made.collect()]
        assert sorted(found, key=repr) == sorted([(1, one), (5, two), (5, three), (None, four)], key=repr)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_empty_tables(spark, stage):
    assert stage[1](spark, spark.createDataFrame([], SCHEMA), "").collect() == []


CLASHING = ("row", "size", "uses", "row_key", "score", "accepted", "lang_pred", "rank", "own", "place", "extra", "component_id", "a b.c")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_other_columns_stay(spark, tmp_path, name):
    folder = f"file://{tmp_path}"
    frame = spark.createDataFrame(docs(), SCHEMA)
    for c in CLASHING:
        frame = frame.withColumn(c, F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    frame.write.parquet(f"{folder}/docs")
    read = spark.read.parquet(f"{folder}/docs")
    made = dict(corpus_pipeline.STAGES)[name](spark, read, folder)
    assert made.columns == read.columns
    plain = dict(corpus_pipeline.STAGES)[name](spark, read.select("doc_id", "text", "lang", "source", "n_chars"), folder)
    rows = made.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    for r in rows:
        assert tuple(r)[5:] == tuple(f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in CLASHING)
