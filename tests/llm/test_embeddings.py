import inspect

import numpy as np
import pytest

from certflow.llm import embeddings
from certflow.llm.embeddings import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, unit string"


def clusters(seed, groups=6, size=40, dim=16, noise=0.08):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        centre = rng.standard_normal(dim)
        out += [centre / np.linalg.norm(centre) + rng.standard_normal(dim) * noise for _ in range(size)]
    return [x.astype(np.float32).tolist() for x in out]


def brute(rows):
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    near = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= 0.9] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [4, 512])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK_VECTORS", block)
    vectors = clusters(block)
    rows = list(enumerate(vectors))
    rows += [(900 + k, vectors[3]) for k in range(30)] + [(900, vectors[3])]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [None] + [1.0] * 15), (1005, [float("inf")] * 16),
             (None, vectors[0]), (1006, [1.0, 0.0]), (1007, [2.0, 0.1]), (1008, [1e-30, 0.0])]
    frame = spark.createDataFrame([(i, v, 0, "own") for i, v in rows], SCHEMA)
    # many tables, so that no link near the threshold is missed
    got = sorted(map(tuple, near_vectors(frame, tables=160, hashes=6).collect()), key=repr)
    assert got == brute(rows)


def test_recall_at_production_settings(spark):
    rows = list(enumerate(clusters(1, groups=30, size=20, dim=64, noise=0.045)))
    got = near_vectors(spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)).collect()
    found, there = sum(r["n_links"] for r in got), sum(r[1] for r in brute(rows))
    assert there > 1000 and 0.97 * there <= found <= there


@pytest.mark.parametrize("cosine", [0.90, 0.92])
def test_planted_pairs_share_a_table(cosine):
    default = {k: v.default for k, v in inspect.signature(near_vectors).parameters.items()}
    rng = np.random.default_rng(int(cosine * 100))
    a, b = rng.standard_normal((2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    project = embeddings.Projections(64, *(default[k] for k in ("tables", "hashes", "width", "seed")))
    assert (~(project(a) == project(b)).any(1)).sum() <= 3


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
