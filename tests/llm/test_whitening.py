import numpy as np
import pytest

from certflow.llm.whitening import eigenvectors, whiten

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string, w string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, "c", "n", "x", "w") for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    centred = (n * x - s).astype(np.float64) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum(int(c) ** 2 for c in row) for row in n * x - s]
    return centred @ axes / np.sqrt(values), deviation, values / values.sum()


def test_equals_numpy(spark):
    rng = np.random.default_rng(5)
    data = (rng.normal(size=(500, 12)) * np.linspace(0.05, 2, 12)).astype(np.float32).tolist()
    rows = whiten(frame(spark, data).repartition(5)).collect()
    expected, deviation, share = brute(data)
    assert len(rows) == 500 * 8
    signs = {}
    for r in sorted(rows, key=lambda r: (-abs(r.whitened), r.vec_id)):
        k = r.component - 1
        sign = signs.setdefault(k, np.sign(r.whitened * expected[r.vec_id, k]))
        assert abs(r.whitened * sign - expected[r.vec_id, k]) < 1e-9
        assert (r.n, r.deviation) == (500, deviation[r.vec_id])
        assert abs(r.explained / share[k] - 1) < 1e-9 and r.identity_error < 1e-9


def test_left_out_repeated_and_null_ids(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [3.0, 1.0], [3.0, 1.0], [-1.0, 0.5]]
    bad = [None, [nan, 1.0], [inf, 1.0], [-inf, 0.0], [None, 1.0], [], [1.0], [1.0, 2.0, 3.0]]
    rows = whiten(frame(spark, good + bad, [1, None, 7, 7, *range(20, 28)])).collect()
    assert sorted([(r.vec_id, r.component) for r in rows], key=str) == sorted([(i, c) for i in (1, None, 7, 7) for c in (1, 2)], key=str)
    assert {r.n for r in rows} == {4}
    assert sorted(r.deviation for r in rows) == sorted(2 * brute(good)[1])


def test_lengths_on_a_tie_the_longer_one(spark):
    rows = whiten(frame(spark, [[1.0], [2.0], [1.0, 5.0], [2.0, 9.0]])).collect()
    assert {r.vec_id for r in rows} == {2, 3}


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_to_whiten(spark, vectors):
    made = whiten(frame(spark, vectors))
    assert made.collect() == []
    assert [f.simpleString() for f in made.schema] == [
        "vec_id:bigint", "component:int", "n:bigint", "deviation:bigint", "whitened:double", "explained:double", "identity_error:double"]


def test_large_entries_stay_exact(spark):
    data = [[3e8, 1.0, 0.0], [-2.5e8, 0.5, 1.0], [1e8, 0.25, -1.0], [7.0, 0.0, 0.5]]
    assert {r.vec_id: r.deviation for r in whiten(frame(spark, [[c / 1e6 for c in v] for v in data])).collect()} == dict(
        enumerate(brute([[c / 1e6 for c in v] for v in data])[1]))
    with pytest.raises(Exception, match="too large"):
        whiten(frame(spark, [[1e30, 1.0], [1.0, 2.0]])).collect()


def spectrum(values, seed=3):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ (np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
    a = (q * np.asarray(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("values, tolerance", [
    (np.linspace(100, 1, 40), 1e-15),
    (np.r_[np.linspace(50, 2, 30), 1 + 1e-6 * np.arange(10)[::-1]], 1e-11),   # far below what float32 tells apart
    (1 + 1e-7 * np.arange(32)[::-1], 1e-9),                                   # one cluster as a whole
    (1 + 1e-10 * np.arange(6)[::-1], 1e-7),
])
def test_clusters(values, tolerance):
    a, q = spectrum(values)
    found, x = eigenvectors(a)
    assert np.abs(found - values).max() < 1e-15 * values.max()
    assert np.abs(np.abs((x.T @ q).astype(float)) - np.eye(len(values))).max() < tolerance
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14


def test_equal_eigenvalues_and_zeros():
    a, _ = spectrum([5, 5, 5, 2, 2, 0, 0])
    found, x = eigenvectors(a)
    assert np.allclose(found, [5, 5, 5, 2, 2, 0, 0], atol=1e-15)
    assert np.abs(a @ x - x * found).max() < 1e-14 and np.abs(x.T @ x - np.eye(7)).max() < 1e-14
    assert eigenvectors(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
