"""Whitening of embeddings by principal components: exact sums in tasks, eigenvectors refined from float32."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certflow.llm.tasks import stored

EXACT = 2**53  # integers up to here are exact in a double
LARGEST = 2**52  # a scaled entry beyond it has no exact place beside its neighbours


def refined_step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One correction of Ogita and Aishima of the approximate eigenvectors `x` (columns) of the symmetric `a`.

    Returns the corrected vectors, their eigenvalues, the distance below which two eigenvalues
    count as a cluster (their vectors are only made orthogonal), and the error before the step
    (residual and loss of orthogonality, relative to `a`).
    """
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    size = np.sqrt((a * a).sum())
    near = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    error = max(np.abs(off - np.diag(np.diag(off))).max() / size, np.abs(r).max())
    return x + x @ e, values, float(near), float(error)


def orthonormal(x: np.ndarray) -> np.ndarray:
    """The nearest matrix with orthonormal columns, by matrix multiplications; `x` is close to it."""
    eye, before = np.eye(x.shape[1], dtype=x.dtype), np.inf
    while True:
        r = eye - x.T @ x
        error = np.abs(r).max()
        if not error < before / 2:
            return x
        x, before = x + x @ r / 2, error


def sub_solved(a: np.ndarray, x: np.ndarray, values: np.ndarray, near: float) -> np.ndarray:
    """Vectors of each cluster of eigenvalues turned by the eigenvectors of `a`, shifted into the cluster and cut down to it.

    The shift leaves a small matrix of the cluster's own width, so a solve in double precision
    tells apart what the whole matrix could not.
    """
    x, order = x.copy(), np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    for own in np.split(order, cuts):
        if len(own) > 1:
            v = x[:, own]
            block = v.T @ (a @ v - values[own].mean() * v)
            width = np.abs(block).max()
            if width > 0:
                turn = np.linalg.eigh((((block + block.T) / 2) / width).astype(np.float64))[1]
                x[:, own] = orthonormal(v @ turn.astype(a.dtype))
    return x


def eigenvectors(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    float32 vectors are the start. Rounds in extended precision (np.longdouble) follow: the vectors
    are made orthonormal, clusters are turned by sub-solves, and a correction doubles the right
    digits where eigenvalues lie apart; so clusters dissolve round by round. It ends where the
    error stops falling. Equal eigenvalues have any orthonormal basis of theirs. Of each vector,
    the entry of largest magnitude is positive.
    """
    a = np.asarray(a, np.longdouble)
    scale = np.abs(a).max() if a.size else 0
    if not scale > 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = orthonormal(np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble))
    best, kept, since = np.inf, (x, np.diag(x.T @ a @ x)), 0
    for _ in range(rounds):
        after, values, near, error = refined_step(a, x)
        since = 0 if error < best / 2 else since + 1
        if error < best:
            best, kept = error, (x, values)
        if since > 2 or best < 4 * np.finfo(np.longdouble).eps:
            break
        x = orthonormal(sub_solved(a, orthonormal(after), values, near))
    x, values = kept
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(x.shape[1])])
    return (values[order] * scale).astype(np.float64), x.astype(np.float64)


def quotient(a: int, b: int) -> np.longdouble:
    """a / b in extended precision."""
    high = a / b
    p, q = high.as_integer_ratio()
    return np.longdouble(high) + np.longdouble((a * q - p * b) / (b * q))


@dataclass
class Moments:
    """Exact sums of the fit list: base = floor of the means, rest = sums of x - base, products = sums of their products."""

    n: int
    sums: list[int]
    products: list[list[int]]

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        return [s % self.n for s in self.sums]

    def covariance(self) -> np.ndarray:
        t, n = self.rest, self.n
        return np.array([[quotient(n * g - t[i] * t[j], n * n) for j, g in enumerate(row)]
                         for i, row in enumerate(self.products)], np.longdouble)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: int, offset: int) -> DataFrame:
    """vec_id and x = floor(scale * entry) + offset, of the vectors that hold finite numbers only."""
    entry = lambda c: F.floor(c * F.lit(float(scale))).cast("long") + F.lit(offset).cast("long")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    held = lambda c: F.when(F.abs(c) * float(scale) < float(LARGEST), entry(c)).otherwise(
        F.raise_error(F.lit("an entry of a vector is too large for exact integers")).cast("long"))
    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("c"))
            .where(F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", finite))
            .select("vec_id", F.transform("c", held).alias("x")))


def moments(rows: DataFrame, d: int) -> Moments:
    """Two passes over the rows: sums, then products of what is left after the floor of each mean is taken off.

    Tasks add integers, in doubles as long as these are exact; Spark adds their sums as decimals.
    Only sums by dimension and by pair of dimensions reach the driver.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * d
        for batch in batches:
            x = _matrix(batch, d)
            n += len(x)
            # halves of 32 bits can't overflow; their sums are joined as Python integers
            high, low = (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()
            s = [a + (h << 32) + b for a, h, b in zip(s, high, low)]
        if n:
            yield pa.RecordBatch.from_pydict({"i": list(range(-1, d)), "s": list(map(str, [n, *s]))})

    found = {r["i"]: int(r["s"]) for r in rows.select("x").mapInArrow(sums, "i long, s string")
             .groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    if not found:
        return Moments(0, [], [])
    made = Moments(found[-1], [found[i] for i in range(d)], [])
    base = made.base

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            z = _matrix(batch, d) - base
            most = int(np.abs(z).max(initial=0)) ** 2
            if most * len(z) <= EXACT:
                f = z.astype(np.float64)
                total += (f.T @ f).astype(np.int64)
            elif (step := EXACT // most):
                for k in range(0, len(z), step):
                    f = z[k:k + step].astype(np.float64)
                    total += (f.T @ f).astype(np.int64)
            else:
                z = z.astype(object)
                total += z.T @ z
        if total.any():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": list(map(str, total[i, j]))})

    made.products = [[0] * d for _ in range(d)]
    for r in (rows.select("x").mapInArrow(products, "i int, j int, s string")
              .groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).toLocalIterator()):
        made.products[r["i"]][r["j"]] = made.products[r["j"]][r["i"]] = int(r["s"])
    return made


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", *, components: int = 8,
           scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """Each vector in the unit of its leading principal components.

    Entries become integers x = floor(scale * entry) + offset, whose sums and products are
    exact at any number of rows and in any order. The covariance (divisor n, centred) of all
    rows is solved on the driver, which holds a matrix of dimension by dimension, never rows.

    Returns vec_id, component (1 has the largest eigenvalue), n, deviation (sum over dimensions
    of (n * x - S) squared, exact), whitened ((x - S / n) on the component, over the root of its
    eigenvalue), explained (its share of the variance) and identity_error (largest absolute
    entry of the covariance of `whitened`, taken from the rows returned, minus the identity).

    Left out are null and empty vectors, vectors with null or non-finite entries, and vectors of
    another length than most have (the longer one on a tie). Repeated rows and null ids count
    and are returned like others. Components without variance (equal rows, a single row) can't
    be whitened and are not returned; an empty table gives no rows. Entries of 2^52 / scale and
    more, and deviations beyond 64 bits, are errors. Extra columns are ignored.
    """
    rows = integer_vectors(vectors, vec_id, embedding, scale, offset)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths["d"] if lengths else 1
    rows = rows.where(F.size("x") == d)
    fit = moments(rows, d) if lengths else Moments(0, [], [])
    n, v = fit.n, fit.covariance() if fit.n else np.zeros((0, 0))
    values, vectors_ = eigenvectors(v)
    used = values > len(values) * np.finfo(np.float64).eps * values.max(initial=0)
    k = min(components, int(used.sum()))
    values, axes = values[:k], vectors_[:, :k] / np.sqrt(values[:k])
    base, rest = (fit.base, fit.rest) if n else (np.zeros(d, np.int64), [0] * d)
    shift = np.array([t / n for t in rest]) if n else np.zeros(d)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = np.array(rest, object)
        for batch in batches:
            z = _matrix(batch, d) - base
            if d * (n * (int(np.abs(z).max(initial=0)) + 1)) ** 2 < 2**63:
                deviation = ((n * z - t.astype(np.int64)) ** 2).sum(1)
            else:
                deviation = [int(s) for s in ((n * z.astype(object) - t) ** 2).sum(1)]
            on_axes = (z.astype(np.float64) - shift) @ axes
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(deviation, pa.int64()),
                pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * k, on_axes.ravel()),
            ], ["vec_id", "deviation", "w"])

    schema = f"vec_id {id_type}, deviation long, w array<double>"
    if not k:
        made, error = vectors.sparkSession.createDataFrame([], schema), 0.0
    else:
        made = stored(rows.mapInArrow(project, schema), "whitened")
        error = _identity_error(made, k)
    trace = float(np.trace(v)) if n else 1.0
    explained = F.array(*[F.lit(float(e) / trace) for e in values]) if k else F.array().cast("array<double>")
    return made.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def _identity_error(made: DataFrame, k: int) -> float:
    means = made.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k)]).first()
    at = [F.col("w")[i] - F.lit(means[i]) for i in range(k)]
    found = made.agg(*[F.avg(at[i] * at[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first().asDict()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i, k))
