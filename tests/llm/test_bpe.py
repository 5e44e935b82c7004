import hashlib
import random

import pytest

from certflow.llm import bpe

FILE = bpe.tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return bpe.tokenizer(FILE)


def whole(model, text):
    return model.encode(text, add_special_tokens=False).ids


def unsplit(seed, n):
    rng = random.Random(seed)
    parts = ["the", "ing", "e", "é", "é", "Ω", "İ", "'s", "'re", "!!!", "'", "12", "ß", "漢字", "🙂", "<|endoftext|>", "<|end", "of", "x" * 9, "q", ".", "zz"]
    return "".join(rng.choice(parts) for _ in range(n))


@pytest.mark.parametrize("seed", range(60))
def test_tree_equals_whole_encoding(model, seed):
    rng = random.Random(seed)
    text = unsplit(seed, 400)
    if seed % 3 == 0:
        text = text.replace("q", " ")
    if seed % 5 == 0:
        text = "a" * 700 + text[:300] + "ab" * 300
    encoder = bpe.Encoder(FILE)
    step = rng.choice([7, 33, 100])
    cuts = [*range(0, len(text), step), len(text)]
    leaves = [encoder.part(text[a:b], 0, b - a) for a, b in zip(cuts, cuts[1:])]
    for leaf, a in zip(leaves, cuts):
        leaf.spans = [(x + a, y + a) for x, y in leaf.spans]
    assert bpe.tree(encoder, text, leaves, cuts).ids == whole(model, text)


def texts():
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "Hello  Wörld don't <|endoftext|>x y>z"), (4, "Hello  Wörld don't <|endoftext|>x y>z"),
        (None, "no id"), (5, unsplit(1, 3000)), (6, "word " * 3000), (7, " non breaking line"), (8, "a" * 5000),
    ]


def test_query_equals_the_library(spark, model):
    frame = spark.createDataFrame([(i, t, "ids") for i, t in texts()], "doc_id long, text string, ids string")
    encoded = bpe.encode_texts(frame, FILE, leaf_chars=1000)
    got = bpe.digests(bpe.decode_ids(encoded, FILE)).collect()
    also = bpe.digests(bpe.encode_texts(frame, FILE, leaf_chars=1000, decoded=True)).collect()
    want = []
    for i, t in texts():
        ids = whole(model, t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(model.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) == sorted(map(tuple, also), key=repr)


def test_empty_table(spark):
    assert bpe.encode_texts(spark.createDataFrame([], "doc_id long, text string"), FILE).collect() == []


def test_cache_turns_over(model, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 5)
    encoder = bpe.Encoder(FILE)
    for k in range(20):
        text = f"one two three{k} four{k % 3} five"
        assert encoder.ids([text])[0].tolist() == whole(model, text)


def test_deep_tree_is_spread_over_tasks(spark, model):
    rows = [(1, unsplit(2, 9000)), (2, "a" * 5000), (None, unsplit(3, 2500)), (3, "short"), (4, "x" * 40), (4, "x" * 41)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    made = bpe.encode_texts(frame, FILE, leaf_chars=20)
    leaves = sum(-(-len(t) // 20) for _, t in rows if len(t) > 20)
    tasks = -(-leaves // bpe.TASK_LEAVES)
    plan = made._jdf.queryExecution().toString()
    rounds = 1
    while bpe.FAN ** rounds < max(-(-len(t) // 20) for _, t in rows):
        rounds += 1
    assert tasks > 40 and rounds == 3 and "hashpartitioning(row#" in plan and f", {tasks}), REPARTITION_BY_NUM" in plan
    want = [(i, whole(model, t)) for i, t in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in made.collect()), key=repr) == sorted(want, key=repr)


def test_files_that_keep_white_space(spark):
    file = bpe.tokenizer_file("byte_bpe_50k.json")
    other = bpe.tokenizer(file)
    assert bpe.words_apart(bpe.tokenizer(FILE)) and not bpe.words_apart(other)
    rows = [(1, "two  words\n\nand more"), (2, None), (3, unsplit(4, 3000) + " \t end "), (4, "")]
    made = bpe.encode_texts(spark.createDataFrame(rows, "doc_id long, text string"), file, leaf_chars=100, decoded=True)
    assert {r["doc_id"]: (r["ids"], r["decoded"]) for r in made.collect()} == {i: (whole(other, t or ""), t or "") for i, t in rows}


def test_a_long_text_of_over_a_megabyte(spark, model):
    text = unsplit(5, 500_000) + " words " * 50_000 + "Ab" * 200_000
    made = bpe.encode_texts(spark.createDataFrame([(1, text)], "doc_id long, text string"), FILE).collect()
    assert len(text) > 1 << 20 and [r["ids"] for r in made] == [whole(model, text)]
