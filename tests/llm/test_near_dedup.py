import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from certflow.llm import near_dedup
from certflow.llm.components import connected_components
from certflow.llm.near_dedup import MinMaxBands, WordHashes, near_duplicates, shingles

SCHEMA = "doc_id long, text string, node string, n_shingles int"


def brute(docs, width, percent=80):
    def shingled(text):
        w = (text or "").encode().lower().split()
        k = min(width, len(w))
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [shingled(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (one, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        least = min(ids) if sets[i] and ids else one
        out.append((one, len(sets[i]), least, one is not None and one == least))
    return sorted(out, key=repr)


def run(spark, docs, **settings):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)
    return sorted((tuple(r) for r in near_duplicates(frame, **settings).collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (5, "ONE"), (None, "one"), (None, "alone here"), (6, "a b"), (7, "a b")]
    for g in range(4):
        base = [f"g{g}x{rng.randrange(60)}" for _ in range(80)]
        # edits put the members of a group on both sides of the threshold
        docs += [(100 * g + 10 + k, edited(rng, base, rng.randrange(0, 9))) for k in range(30)]
    return docs


@pytest.mark.parametrize("width", [2, 5])
def test_against_brute_force(spark, width):
    docs = corpus(width)
    assert run(spark, docs, width=width) == brute(docs, width)


def test_blocks_of_open_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 3)
    docs = corpus(9)
    # one row of two values: buckets are large and hold unlinked texts, so the block path does the work
    assert run(spark, docs, width=2, bands=12, rows=2) == brute(docs, 2)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_words_are_split_at_ascii_white_space_alone():
    assert len(shingles("a b c\x0bd".encode(), 1, WordHashes())) == 3


def test_min_max_signature_is_unbiased():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(x[:2500]), np.unique(x[500:])
    keys = MinMaxBands(2000, 2, 1)
    low = lambda s: (s[None, :] * keys.factors[:, None] + keys.offsets[:, None])
    same = np.r_[low(a).min(1) == low(b).min(1), low(a).max(1) == low(b).max(1)]
    assert abs(same.mean() - 2000 / 3000) < 0.03


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    frame = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = dict(connected_components(frame, "a", "b").collect())
    near = {}
    for x, y in edges:
        near.setdefault(x, {x}).add(y)
        near.setdefault(y, {y}).add(x)
    for x in [x for x, n in near.items() if n == {x}]:
        del near[x]
    want = {}
    for x in near:
        seen, todo = {x}, [x]
        while todo:
            todo += [z for z in near[todo.pop()] if z not in seen and not seen.add(z)]
        want[x] = min(seen)
    assert got == want
