import math
import random
from collections import Counter

import pytest

from certflow.llm.lm_scoring import from_planes, planes, score_documents


def brute(texts, order, backoff=0.4):
    docs = [(t or "").encode().lower().split() for t in texts]
    grams = lambda w, n: [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
    total = {n: Counter(g for w in docs for g in grams(w, n)) for n in range(1, order + 1)}
    words = sum(map(len, docs))
    out = []
    for w in docs:
        own = {n: Counter(grams(w, n)) for n in range(1, order + 1)}
        count = lambda g: total[len(g)][g] - own[len(g)][g]

        def score(g):
            if len(g) == 1:
                return count(g) / (words - len(w)) if count(g) else 1 / (words - len(w) + 1)
            return count(g) / count(g[:-1]) if count(g) else backoff * score(g[1:])

        out.append(sum(math.log(score(tuple(w[max(0, i - order + 1):i + 1]))) for i in range(len(w))) if w else None)
    return out


@pytest.mark.parametrize(("order", "batch", "part"), [(1, 1 << 20, 1 << 20), (2, 300, 256), (3, 1, 1000), (4, 900, 64)])
def test_against_brute_force(spark, order, batch, part):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("a b c d the The e f g".split()) for _ in range(rng.randrange(40))) for _ in range(40)]
    texts += [None, "", " \n", "alone unseen words", texts[0], texts[0]]
    rows = [(k if k % 9 else None, t, 1) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = sorted(((r["doc_id"], r["n_words"], r["log_score"]) for r in score_documents(frame, order=order, batch_bytes=batch, part_bytes=part).collect()), key=repr)
    want = sorted(((i, len((t or "").split()), s) for (i, t, _), s in zip(rows, brute(texts, order))), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2] == (None if w[2] is None else pytest.approx(w[2]))


def test_planes():
    import numpy as np

    x = np.array([0, 1, 255, 256, 2**63, 2**64 - 1], np.uint64)
    assert np.array_equal(from_planes(planes(x)), x)


def test_empty_table(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
