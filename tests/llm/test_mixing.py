import numpy as np
import pytest

from certflow.llm import mixing
from certflow.llm.mixing import mix, mixed_documents, numbered, permuted, runs, shard_draw, source_targets, taken_words

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, size string"


def shared(sizes):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"b": 100, "a": 1, None: 5, "é": 1000, "Z": 10}, {"x": 7}, {"a": 1, "b": 1, "c": 1, "d": 10_000}, {"a": 0, "b": 5}, {None: 3, "": 4},
])
def test_targets(spark, sizes):
    got = {r["source"]: r["target"] for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    assert got == pytest.approx(shared(sizes))


def test_targets_of_no_words(spark):
    assert [r["target"] for r in source_targets(spark.createDataFrame([("a", 0)], "source string, size long")).collect()] == [0.0]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000, 4097])
def test_permutation(size):
    made = permuted(np.arange(size), size, 5)
    assert sorted(made.tolist()) == list(range(size))
    assert size < 1000 or np.mean(made == np.arange(size)) < 0.01


def test_shards_use_each_quota_exactly():
    slots = np.array([500, 0, 1300, 7])
    seen = [shard_draw(slots, k, 100, 3) for k in range(19)]
    source, rank = np.concatenate([s for s, _ in seen]), np.concatenate([r for _, r in seen])
    assert np.bincount(source, minlength=4).tolist() == slots.tolist()
    for k in (0, 2, 3):
        assert sorted(rank[source == k].tolist()) == list(range(slots[k]))
    first = np.array([np.sum(s == 0) for s, _ in seen[:18]])
    assert 20 < first.mean() < 36 and first.std() > 2  # about 27.7 of 100, and not the same everywhere


def docs(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(k % 90)) + "\n", f"s{k % 5}" if k % 7 else None, "en", 0, "own") for k in range(400)]
    return rows + [(900, None, "s1", None, None, None), (901, "", "s1", "en", 0, ""), (5, rows[5][1], "s0", "en", 0, ""), (None, "a b c", "s2", "en", 0, "")]


def test_taken_words(spark):
    frame = spark.createDataFrame(docs(spark), SCHEMA)
    first, again = (taken_words(frame, block_words=16, shard_blocks=64).collect() for _ in range(2))
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)
    assert len(first) == 404
    total = {}
    for (doc_id, text, source, *_), r in zip(sorted(docs(spark), key=lambda d: repr((d[0], len((d[1] or "").split())))), sorted(first, key=lambda r: repr((r["doc_id"], r["size"])))):
        assert r["size"] == len((text or "").split()) and 0 <= r["taken"] <= 3 * r["size"]
        total.setdefault(source, [r["target"], 0])[1] += r["taken"]
    for target, taken in total.values():
        assert taken == pytest.approx(target, rel=0.05)


def test_files_and_tasks_change_nothing(spark):
    frame = spark.createDataFrame(docs(spark), SCHEMA)
    one, other = (sorted(map(tuple, taken_words(f, block_words=16).collect()), key=repr) for f in (frame.coalesce(1), frame.repartition(7, "text")))
    assert one == other


def test_very_many_sources(spark):
    rows = spark.range(150_000).selectExpr("id AS doc_id", "concat('a b c d e f g', id) AS text", "concat('s', id) AS source")
    made = taken_words(rows, block_words=4).selectExpr("count(*)", "sum(size)", "count_if(taken > 3 * size)", "sum(taken)", "sum(target)").first()
    assert made[:3] == (150_000, 7 * 150_000, 0) and abs(made[3] / made[4] - 1) < 0.1


def test_streams_are_numbered_through(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STREAM_WORDS", 300)
    monkeypatch.setattr(mixing, "GROUP_STREAMS", 3)
    rows = numbered(spark.createDataFrame(docs(spark), SCHEMA))
    targets, made = mix(rows, block_words=16)
    sized = {r["row"]: r["size"] for r in rows.collect()}
    pieces = {}
    for r in made.collect():
        pieces.setdefault((r["source_index"], r["block"]), set()).add((r["row"], r["first"], r["last"]))
    for group in pieces.values():
        assert sum(b - a for _, a, b in group) <= 16
        assert all(0 <= a < b <= sized[row] for row, a, b in group)
    per_row = {}
    for group in pieces.values():
        for row, a, b in group:
            per_row.setdefault(row, []).append((a, b))
    for spans in per_row.values():
        spans.sort()
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_mixed_documents(spark):
    frame = spark.createDataFrame(docs(spark), SCHEMA)
    made = mixed_documents(frame, block_words=16)
    assert made.columns == ["doc_id", "text", "source", "lang", "n_chars", "size"]
    whole = {d[0]: (d[1] or "") for d in docs(spark)}
    rows = made.collect()
    assert rows and all(r["text"] in whole[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in rows)
    words = taken_words(frame, block_words=16).groupBy().sum("taken").first()[0]
    assert sum(len(r["text"].split()) for r in rows) == words


def test_runs():
    use = lambda a, b, n: {"first": a, "last": b, "times": n}
    assert list(runs([use(0, 5, 2), use(5, 9, 1), use(12, 14, 1)])) == [(0, 9), (12, 14), (0, 5)]
    assert list(runs([])) == []


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert taken_words(frame).collect() == [] and mixed_documents(frame).collect() == []
