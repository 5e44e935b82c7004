"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certflow.llm.components import connected_components
from certflow.llm.near_dedup import mixed
from certflow.llm.tasks import stored

BLOCK_VECTORS = 512


class Projections:
    """Bucket keys of vectors: each table joins `hashes` quantised random projections of the normalised vector."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.axes = rng.standard_normal((dim, tables * hashes))
        self.shift = rng.uniform(0, width, tables * hashes)
        self.tables, self.hashes, self.width = tables, hashes, width

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """32-bit keys, one column for each table."""
        cells = np.floor((unit @ self.axes + self.shift) / self.width).astype(np.int64).astype(np.uint64)
        cells = cells.reshape(len(unit), self.tables, self.hashes)
        keys = np.full((len(unit), self.tables), 1, np.uint64)
        for k in range(self.hashes):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
        return (keys >> np.uint64(32)).astype(np.uint32)


def unit_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length 1 in double precision; None for null, empty and zero vectors and such with a null or non-finite component."""
    out: list[np.ndarray | None] = []
    for x in column.to_pylist():
        v = None if x is None or None in x else np.array(x, np.float64)
        if v is None or not len(v) or not np.isfinite(v).all() or not v.any():
            out.append(None)
            continue
        v = v / np.abs(v).max()
        out.append(v / np.sqrt(v @ v))
    return out


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", *, cosine: float = 0.9, tables: int = 96,
    hashes: int = 12, width: float = 2.0, seed: int = 5,
) -> DataFrame:
    """Links of vectors with cosine >= `cosine`, found by hashing and all checked exactly.

    Returns a row per input row: vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable, itself included) and kept (vec_id = component_id).

    Copies (equal bytes) form a class, which one row stands for. A class falls into one bucket in each
    table; a bucket of more than 512 classes is cut into blocks, and every pair of blocks is
    compared as one tile, so neither a bucket nor its pairs lie in one task. A pair that shares several
    tables counts in the first alone. Tiles return counts and, for components, at most one link for each
    pair of groups that they join; pairs are not written out. At the default settings about 7 in
    100,000 pairs at a cosine of 0.9 share no table, and fewer above it.

    Null, empty and zero vectors and such with null or non-finite components link with nothing:
    n_links 0, component_id their own id. Vectors of different lengths never link. Repeated
    rows give a row each and link with one another. A null vec_id is larger than all others;
    kept is false there. Extra columns are ignored.
    """
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    kind = source.schema["vec_id"].dataType.simpleString()

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_vectors(batch.column("embedding"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([None if u is None else u.tobytes() for u in units], pa.binary())], ["vec_id", "unit"])

    rows = stored(source.mapInArrow(normalise, f"vec_id {kind}, unit binary"), "units")
    classes = stored(rows.where(F.col("unit").isNotNull()).groupBy("unit").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
                     .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    settings = (tables, hashes, width, seed)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Projections] = {}
        for batch in batches:
            units = [np.frombuffer(u, np.float64) for u in batch.column("unit").to_pylist()]
            keys: list = [None] * len(units)
            for dim in {len(u) for u in units}:
                at = [k for k, u in enumerate(units) if len(u) == dim]
                project = made.setdefault(dim, Projections(dim, *settings))
                for k, row in zip(at, project(np.stack([units[k] for k in at]))):
                    keys[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(u) for u in units], pa.int64()), pa.array(keys, pa.binary())], [*batch.schema.names, "dim", "keys"])

    keyed = stored(classes.select("node", "copies", "unit").mapInArrow(
        hashed, "node long, copies long, unit binary, dim long, keys binary"), "vector-keys")
    place = F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))
    spread = keyed.select("node", "dim", "keys", place.alias("t")).select(
        "node", F.concat_ws("/", "dim", "t", F.hex(F.substring("keys", F.col("t") * 4 + 1, F.lit(4)))).alias("bucket"), "t")
    # what is joined to rows by a key that may be hot is stored first, so that Spark can split the rows of the key
    sizes = stored(spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
                   .withColumn("blocks", F.ceil(F.col("n") / BLOCK_VECTORS)), "bucket-sizes")
    member = spread.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    other = member.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiled = other.select(
        "node", "t", "block", "blocks", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "bucket")
    tiles = (tiled.withColumn("tile", F.concat_ws("/", "bucket", "low", "high"))
             .withColumn("side", F.col("block") == F.col("high")).drop("bucket", "blocks")
             .join(keyed.select("node", "copies", "unit", "keys"), "node"))
    # The keys of earlier tables tell whether the pair was counted there.
    tiles = tiles.select("tile", "t", "low", "high", "side", "node", "copies", "unit", F.substring("keys", F.lit(1), F.col("t") * 4).alias("earlier"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_tiles(batches):
            for out in compared(batch, cosine):
                yield out

    found = stored(tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(
        compare, "node long, other long, links long"), "vector-links")
    labels = stored(connected_components(found.where(F.col("other").isNotNull()), "node", "other"), "vector-labels")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(counts, "node", "left").join(labels, "node", "left").select(
        "unit", "least_id", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = stored(known.groupBy("component").agg(F.min("least_id").alias("component_id")), "least-ids")
    known = known.join(least, "component").select("unit", "n_links", "component_id")
    lone = F.col("unit").isNull()
    return rows.join(known, "unit", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(lone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches cut at tile borders; only the last, unfinished tile is carried over."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        tile = batch.column("tile")
        first, last = tile[0], tile[len(tile) - 1]
        if held and held[-1].column("tile")[0] != first:
            yield pa.Table.from_batches(held)
            held = []
        if first == last:
            held.append(batch)
            continue
        begins = tile.to_pylist().index(last.as_py())
        yield pa.Table.from_batches([*held, batch.slice(0, begins)])
        held = [batch.slice(begins)]
    if held:
        yield pa.Table.from_batches(held)


def compared(table: pa.Table, cosine: float) -> Iterator[pa.RecordBatch]:
    """Link counts and joining links of whole tiles: node, other, links."""
    tile = np.array(table["tile"].to_pylist(), object)
    starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    nodes, copies = table["node"].to_numpy(), table["copies"].to_numpy()
    side, low, high = table["side"].to_pylist(), table["low"].to_numpy(), table["high"].to_numpy()
    units, earlier = table["unit"].to_pylist(), table["earlier"].to_pylist()
    for start, end in zip(starts, np.r_[starts[1:], len(tile)]):
        x = np.stack([np.frombuffer(u, np.float64) for u in units[start:end]])
        near = x @ x.T >= cosine - 1e-9
        np.fill_diagonal(near, False)
        if low[start] != high[start]:
            upper = np.array(side[start:end])
            near &= upper[:, None] != upper[None, :]
        a, b = np.nonzero(np.triu(near))
        if not len(a):
            continue
        keys = np.stack([np.frombuffer(e, np.uint32) for e in earlier[start:end]])
        keep = np.empty(len(a), bool)
        for k in range(0, len(a), 8192):
            p, q = a[k:k + 8192], b[k:k + 8192]
            exact = np.array([_cosine(x[i], x[j]) >= cosine for i, j in zip(p, q)]) if _close(x, p, q, cosine).any() else True
            keep[k:k + 8192] = ~(keys[p] == keys[q]).any(1) & exact
        a, b = a[keep], b[keep]
        own = copies[start:end]
        links = np.bincount(a, own[b], end - start) + np.bincount(b, own[a], end - start)
        joined: list[tuple[int, int]] = []
        root = list(range(end - start))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        for i, j in zip(a.tolist(), b.tolist()):
            i, j = find(i), find(j)
            if i != j:
                root[max(i, j)] = min(i, j)
                joined.append((i, j))
        at = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.r_[nodes[start:end][at], nodes[start:end][[i for i, _ in joined]]].astype(np.int64)),
            pa.array([None] * len(at) + [int(nodes[start + j]) for _, j in joined], pa.int64()),
            pa.array(np.r_[links[at], np.zeros(len(joined))].astype(np.int64))], ["node", "other", "links"])


def _close(x: np.ndarray, p: np.ndarray, q: np.ndarray, cosine: float) -> np.ndarray:
    return np.abs(np.einsum("ij,ij->i", x[p], x[q]) - cosine) < 1e-9


def _cosine(x: np.ndarray, y: np.ndarray) -> float:
    return float(np.sum(x * y))
