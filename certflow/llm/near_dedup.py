"""Near-duplicate documents by min-max hashing over word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certflow.llm.components import connected_components
from certflow.llm.tasks import as_bytes, groups, steps, stored

BLOCK_SETS = 256
BLOCK_BYTES = 16 << 20
WORD_CACHE = 200_000


class WordHashes(dict):
    """64-bit hashes of words, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct `width`-word shingles of a text, A-Z lower-cased.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    rolled = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + each[k:len(words) - width + 1 + k])
    return np.unique(rolled)


class MinMaxBands:
    """Band keys of a set: each band joins minima and maxima of `rows / 2` permutations."""

    def __init__(self, bands: int, rows: int, seed: int):
        if rows % 2:
            raise ValueError("a band takes a minimum and a maximum of each permutation: rows must be even")
        rng = np.random.default_rng(seed)
        n = bands * rows // 2
        self.bands = bands
        self.factors = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = rng.integers(0, 2**63, n, dtype=np.uint64)
        self.start = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def __call__(self, values: np.ndarray, step: int = 1024) -> np.ndarray:
        low = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.factors), np.uint64)
        for k in range(0, len(values), step):
            permuted = values[None, k:k + step] * self.factors[:, None] + self.offsets[:, None]
            np.minimum(low, permuted.min(1), out=low)
            np.maximum(high, permuted.max(1), out=high)
        keys = self.start.copy()
        for part in (*low.reshape(self.bands, -1).T, *high.reshape(self.bands, -1).T):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + part)
        return keys.view(np.int64)


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, width: int = 5, percent: int = 80,
    bands: int = 40, rows: int = 6, seed: int = 7,
) -> DataFrame:
    """Groups of documents that links of similarity >= percent / 100 join.

    Returns a row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable,
    itself included) and kept (doc_id = component_id). Two documents are linked if the Jaccard
    similarity of their shingle sets (64-bit hashes of `width` words) is percent / 100 or more.

    Copies of one set form a class, which a row stands for from there on. Classes that share a
    band are candidates: at a similarity of 0.8 and the default bands, 5 in a million pairs
    share none. In each bucket, all members are compared with the smallest; buckets in which
    the other members then still belong to several components are compared in blocks, each
    member outside the bucket's largest component with all members. So the pairs of a bucket
    are never written out, and no bucket is cut. Every link is confirmed on full sets.

    Null or empty texts, and texts of white space, have no shingle and link with nothing:
    component_id is their own doc_id. Repeated rows give a row each. A null doc_id counts as
    larger than all others; kept is false there and where only null ids form the component.
    Extra columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys = WordHashes(), MinMaxBands(bands, rows, seed)
        for batch in steps(batches):
            sets = [shingles(x, width, hashes) for x in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([digest(s) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([keys(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ], ["doc_id", "digest", "n", "bands"])

    sketches = stored(docs.mapInArrow(sketch, f"doc_id {id_type}, digest binary, n long, bands array<long>"), "sketches")
    classes = stored(
        sketches.where("n > 0").groupBy("digest")
        .agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    spread = classes.select("node", F.explode("bands").alias("bucket"))
    # what is joined to rows by a key that may be hot is stored first, so that Spark can split the rows of the key
    buckets = stored(spread.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1"), "buckets")
    members = stored(
        spread.join(buckets, "bucket").where("node != leader").select("bucket", "leader", "node", "size"), "members")

    pairs = members.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    sets = _sets(docs, classes, members, width)
    links = stored(_confirmed(pairs, sets, percent), "links")
    labels = stored(connected_components(links, "a", "b"), "labels")
    rest = stored(_block_links(members, labels, sets, percent), "block-links")
    if not rest.isEmpty():
        labels = stored(connected_components(links.union(rest), "a", "b"), "labels")

    nodes = classes.join(labels, "node", "left").select(
        "digest", "least_id", F.coalesce("component", "node").alias("component"))
    least = stored(nodes.groupBy("component").agg(F.min("least_id").alias("component_id")), "least-ids")
    ids = nodes.join(least, "component").select("digest", "component_id")
    return sketches.drop("bands").join(ids, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _sets(docs: DataFrame, classes: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """node, n and sorted shingle hashes of each class that shares a bucket, made anew from one text of the class."""
    used = members.select("node").union(members.select("leader")).distinct()
    wanted = stored(classes.select("node", "digest", "least_id").join(used, "node"), "wanted")
    ids = wanted.select("least_id").distinct()
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["least_id"]), "left_semi").select("text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in steps(batches):
            sets = [shingles(x, width, hashes) for x in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["digest", "shingles"])

    made = texts.mapInArrow(build, "digest binary, shingles binary")
    return stored(
        made.join(wanted, "digest").groupBy("node").agg(F.first("shingles").alias("shingles"))
        .withColumn("n", F.expr("octet_length(shingles) div 8")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"), F.col("n").alias("n_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"), F.col("n").alias("n_b"))
    near = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                hit.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").where(near).select("a", "b", "set_a", "set_b").mapInArrow(confirm, "a long, b long")


def _block_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components inside buckets whose members, the leader aside, still belong to several.

    A tile holds a block of members outside the bucket's largest component and a block of all
    members; it returns at most one link for each pair of components that it joins.
    """
    left = (members.join(labels, "node", "left").join(sets.select("node", "n"), "node")
            .select("bucket", "node", "n", F.coalesce("component", "node").alias("label")))
    open_ = stored(left.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi"), "open")
    left = stored(left.join(open_.select("bucket"), "bucket"), "open-buckets")
    main = (left.groupBy("bucket", "label").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
            .groupBy("bucket").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("c"),
                                   F.sum("s").alias("s"), F.max("c").alias("main_c"))
            .withColumn("m_blocks", F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("s") * 8 / BLOCK_BYTES)))
            .withColumn("q_blocks", F.ceil((F.col("c") - F.col("main_c")) * F.col("m_blocks") / F.col("c"))))
    left = left.join(stored(main, "main-components"), "bucket")
    block = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asked = left.where("label != main").select("bucket", "node", "label", block("q_blocks", 1).alias("q"), every("m_blocks").alias("m"), F.lit(True).alias("asks"))
    held = left.select("bucket", "node", "label", every("q_blocks").alias("q"), block("m_blocks", 2).alias("m"), F.lit(False).alias("asks"))
    tiles = (asked.union(held).join(sets.select("node", "shingles"), "node")
             .withColumn("tile", F.concat_ws("/", "bucket", "q", "m"))
             .select("tile", "asks", "node", "label", "shingles"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "tile"):
            found = list(_tile(rows, percent))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found]), pa.array([y for _, y in found])], ["a", "b"])

    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(compare, "a long, b long")


def _tile(rows: list[dict], percent: int) -> Iterator[tuple[int, int]]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    held = [r for r in rows if not r["asks"]]
    if not held:
        return
    arrays = [np.frombuffer(r["shingles"], np.uint64) for r in held]
    sizes = np.array([len(x) for x in arrays])
    flat, owner = np.concatenate(arrays), np.repeat(np.arange(len(arrays)), sizes)
    for r in rows:
        if not r["asks"]:
            continue
        own = np.frombuffer(r["shingles"], np.uint64)
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        common = np.bincount(owner[own[at] == flat], minlength=len(held))
        for k in np.flatnonzero(100 * common >= percent * (len(own) + sizes - common)):
            x, y = find(r["label"]), find(held[k]["label"])
            if x != y:
                root[max(x, y)] = min(x, y)
                yield r["node"], held[k]["node"]
