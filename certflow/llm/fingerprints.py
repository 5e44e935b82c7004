"""Document fingerprints: minima of many permutations over character shingles, matched by bands."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certflow.llm.keyfilter import key_filter, may_hold
from certflow.llm.near_dedup import mixed
from certflow.llm.tasks import steps, stored

START = 0x110000  # stands before the text; no code point has this value
FACTOR = np.uint64(0x9E3779B97F4A7C15)
PLACE_CHARS = 8 << 20  # characters of a range of documents, on average


class MinHash:
    """`hashes` universal permutations x -> a * x + b of 32-bit integers (a odd), and the least value of each over a text.

    The shingle at a character is that character with the `width - 1` before it, the start
    being padded; so a text has as many as characters, and short texts are compared like long ones.
    """

    def __init__(self, hashes: int = 128, width: int = 12, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.width = width
        self.a = rng.integers(0, 2**31, (hashes, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 2**32, (hashes, 1), dtype=np.uint32)

    def points(self, text: str | None) -> np.ndarray:
        """Code points of a text after the padding."""
        return np.r_[np.full(self.width - 1, START, np.uint32), np.frombuffer((text or "").encode("utf-32-le"), np.uint32)]

    def shingles(self, points: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """64-bit hashes of the shingles at the characters from `lo` up to `hi`."""
        found = np.zeros(hi - lo, np.uint64)
        for k in range(self.width):
            found = found * FACTOR + points[lo + k:hi + k]
        return mixed(found)

    def minima(self, points: np.ndarray, lo: int, hi: int, hashes: int | None = None, block: int = 1 << 16, step: int = 1024) -> np.ndarray:
        """The least values of the first `hashes` permutations (all without a number) over the characters from `lo` up to `hi`."""
        a, b = self.a[:hashes], self.b[:hashes]
        low = np.full(len(a), 0xFFFFFFFF, np.uint32)
        for start in range(lo, hi, block):
            x = (self.shingles(points, start, min(start + block, hi)) >> np.uint64(32)).astype(np.uint32)
            for k in range(0, len(x), step):
                np.minimum(low, (x[None, k:k + step] * a + b).min(1), out=low)
        return low

    def whole(self, text: str | None, hashes: int | None = None) -> np.ndarray:
        points = self.points(text)
        return self.minima(points, 0, len(points) - self.width + 1, hashes)


def spelled(minima: np.ndarray) -> str:
    """The fingerprint: 16 bits of each minimum, in hexadecimal digits."""
    return minima.astype(">u2").tobytes().hex()


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of equal minima, which estimates the Jaccard similarity of the shingles."""
    return float((x.astype(np.uint16) == y.astype(np.uint16)).mean())


def band_keys(minima: np.ndarray, bands: int) -> np.ndarray:
    keys = mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for part in minima.reshape(bands, -1).T:
        keys = mixed(keys * FACTOR + part)
    return keys.view(np.int64)


def jaccard(minhash: MinHash, one: str, two: str) -> float:
    """Similarity of the full sets of shingles; two empty texts are alike."""
    sets = [np.unique(minhash.shingles(p, 0, len(p) - minhash.width + 1)) for p in map(minhash.points, (one, two))]
    common = len(np.intersect1d(*sets, assume_unique=True))
    return common / max(1, len(sets[0]) + len(sets[1]) - common) if len(sets[0]) or len(sets[1]) else 1.0


def digest(text: str | None) -> bytes:
    return hashlib.blake2b((text or "").encode(), digest_size=16).digest()


def row_key(doc_id: object, text_digest: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text_digest + repr(doc_id).encode())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, minhash: MinHash = MinHash()) -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint of each row. A null text is empty; equal texts have equal fingerprints."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(t or "") for t in texts], pa.int64()),
                pa.array([spelled(minhash.whole(t)) for t in texts], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, minhash: MinHash = MinHash(), bands: int = 14,
            rows: int = 5, least: float = 0.8) -> DataFrame:
    """The document that each document repeats: doc_id, digest (of the text), n_chars, match_id; a row for each doc_id and text.

    Texts that share a band of their minima with others are compared with the bucket's smallest document,
    on full sets of shingles; match_id is the smallest doc_id among the confirmed ones, those
    with the same text, and the document itself. At a similarity of 0.8 and the
    default 14 bands of 5, four in a thousand pairs share no band. Buckets are joined with their
    smallest document only, so a large group costs as many pairs as it has texts. A bit table of the buckets that
    occur twice leaves out most others before anything else is joined. Chains are not followed: of `match_id`
    only likeness to the document itself is claimed. Empty texts match empty texts. Null ids count as larger than all others.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(map(digest, texts), pa.binary()), pa.array([len(t or "") for t in texts], pa.int64()),
                pa.array([band_keys(minhash.whole(t, bands * rows), bands) for t in texts], pa.list_(pa.int64()))], ["doc_id", "digest", "n_chars", "bands"])

    known = stored(docs.mapInArrow(sketch, f"doc_id {id_type}, digest binary, n_chars long, bands array<long>"), "fingerprint-bands")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("first")
    texts = stored(known.groupBy("digest").agg(first, F.first("bands").alias("bands")), "fingerprint-texts")
    often = texts.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    table = docs.sparkSession.sparkContext.broadcast(key_filter(often, "bucket"))

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 4096):
            keys = batch.column("bands").flatten().to_numpy()
            hit = may_hold(table.value, keys.view(np.uint64))
            found = pa.ListArray.from_arrays(np.r_[0, np.cumsum(hit)][np.arange(batch.num_rows + 1) * bands].astype(np.int32), pa.array(keys[hit]))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("first"), found], ["digest", "first", "bands"])

    shared = texts.select("digest", "first", "bands").mapInArrow(repeated, texts.select("digest", "first", "bands").schema)
    spread = shared.select(F.struct("first.no_id", "first.doc_id", "digest").alias("own"), F.explode("bands").alias("bucket"))
    buckets = stored(spread.groupBy("bucket").agg(F.min("own").alias("leader"), F.count("*").alias("size")).where("size > 1").drop("size"),
                     "fingerprint-buckets")
    pairs = stored(spread.join(buckets, "bucket").where("own.digest != leader.digest").select("own", "leader").distinct(), "fingerprint-pairs")

    wanted = pairs.select(F.col("own").alias("x")).union(pairs.select(F.col("leader").alias("x"))).distinct()
    held = _texts(docs, wanted.select("x.doc_id", "x.digest"))
    one, two = (held.select(F.col("digest").alias(d), F.col("text").alias(t)) for d, t in (("own_digest", "own_text"), ("leader_digest", "leader_text")))
    asked = pairs.withColumns({"own_digest": F.col("own.digest"), "leader_digest": F.col("leader.digest")}).join(one, "own_digest").join(two, "leader_digest")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 64):
            hit = [jaccard(minhash, x, y) >= least for x, y in zip(batch.column("own_text").to_pylist(), batch.column("leader_text").to_pylist())]
            yield batch.select(["own_digest", "leader_id"]).filter(pa.array(hit, pa.bool_()))

    links = asked.select("own_digest", F.col("leader.doc_id").alias("leader_id"), "own_text", "leader_text").mapInArrow(
        confirm, f"own_digest binary, leader_id {id_type}")
    least_link = links.groupBy(F.col("own_digest").alias("digest")).agg(F.min("leader_id").alias("linked"))
    ids = stored(texts.join(least_link, "digest", "left").select("digest", F.least("first.doc_id", "linked").alias("match_id")), "fingerprint-matches")
    return known.select("doc_id", "digest", "n_chars").distinct().join(ids, "digest").select("doc_id", "digest", "n_chars", "match_id")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """digest and text of the wanted documents: a bit table leaves most others out before the join."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 4096):
            keys = np.array(list(map(row_key, batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist())), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

    table = docs.sparkSession.sparkContext.broadcast(key_filter(wanted.mapInArrow(keyed, "key long"), "key"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            digests = list(map(digest, batch.column("text").to_pylist()))
            keys = np.array(list(map(row_key, batch.column("doc_id").to_pylist(), digests)), np.uint64)
            made = pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column("text")], ["digest", "text"])
            yield made.filter(pa.array(may_hold(table.value, keys)))

    held = docs.mapInArrow(chosen, "digest binary, text string")
    return stored(held.join(wanted.select("digest"), "digest", "left_semi").dropDuplicates(["digest"]), "fingerprint-sets")


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, minhash: MinHash = MinHash()) -> DataFrame:
    """Fingerprints of each document and of an edited form, whose last quarter is taken from the next document.

    Of n_chars code points the last floor(n_chars / 4) give way to the first as many (or all) of
    the next document, by ascending doc_id (nulls last, equal ids by digest of the text; repeated rows are one
    document); after the last comes the first. Returns doc_id, n_chars, edited_sha256 (of the UTF-8), fingerprint,
    edited_fingerprint, near_edited and near_next (likeness of its fingerprint to those of the
    edited text and of the next document) and match_id (see `matches`).

    A null text is empty; the likeness of two empty texts is 1. A text is taken whole by one task.
    An empty table gives no rows. Extra columns are ignored.

    The documents are cut into ranges by exact bounds. Texts move once, to their range; the first of each
    range goes to the range before as well, so neighbours meet without a second pass.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    known = stored(matches(docs, minhash=minhash).withColumn("no_id", F.col("doc_id").isNull()), "fingerprint-known")
    places = 1 + int((known.agg(F.sum("n_chars")).first()[0] or 0) // PLACE_CHARS)
    order = ["no_id", "doc_id", "digest"]
    # one bound for each range, so no more than the size of all texts over PLACE_CHARS
    firsts = (known.select(*order).repartitionByRange(places, *order).groupBy(F.spark_partition_id().alias("place"))
              .agg(F.min(F.struct(*order)).alias("own")).collect())
    shared = spark.sparkContext.broadcast(sorted(_order(r["own"]["doc_id"], bytes(r["own"]["digest"])) for r in firsts))
    schema = f"place int, tail boolean, no_id boolean, doc_id {id_type}, digest binary, kind int, text binary, match_id {id_type}"

    def batch_of(rows: list[tuple], kind: int, ids: pa.DataType) -> pa.RecordBatch:
        place, tail, own, digests, texts, found = zip(*rows) if rows else ((),) * 6
        own = pa.array(own, ids)
        return pa.RecordBatch.from_arrays([
            pa.array(place, pa.int32()), pa.array(tail, pa.bool_()), own.is_null(), own, pa.array(digests, pa.binary()),
            pa.array([kind] * len(own), pa.int32()), pa.array(texts, pa.binary()), pa.array(found, ids)], schema_names)

    schema_names = ["place", "tail", "no_id", "doc_id", "digest", "kind", "text", "match_id"]
    place_of = lambda key: bisect_right(shared.value, key) - 1

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = {key: (k - 1) % len(shared.value) for k, key in enumerate(shared.value)}
        pack = zstandard.ZstdCompressor().compress  # texts travel packed
        for batch in steps(batches):
            rows = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                key, packed = _order(i, digest(t)), pack((t or "").encode())
                rows.append((place_of(key), False, i, key[2], packed, None))
                if key in before:
                    rows.append((before[key], True, i, key[2], packed, None))
            yield batch_of(rows, 1, batch.column("doc_id").type)

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 4096):
            rows = [(place_of(_order(r["doc_id"], r["digest"])), False, r["doc_id"], r["digest"], None, r["match_id"]) for r in batch.to_pylist()]
            yield batch_of(rows, 0, batch.column("doc_id").type)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        unpack = zstandard.ZstdDecompressor().decompress
        place, held, match = None, None, None
        for batch in steps(batches, 64):
            for r in batch.to_pylist():
                if r["place"] != place:
                    place, held = r["place"], None
                if r["kind"] == 0:
                    match = r["match_id"]
                    continue
                key = _order(r["doc_id"], r["digest"])
                if held and not r["tail"] and held.key == key:
                    held.rows += 1
                    continue
                if r["tail"] and not held:
                    continue
                after = _Open(minhash, key, r["doc_id"], unpack(r["text"]).decode(), match)
                if held:
                    made += [held.result(minhash, after)] * held.rows
                held = None if r["tail"] else after
            if len(made) >= 64:
                yield _results(made, batch.column("doc_id").type)
                made = []
        if made:
            yield _results(made, batch.column("doc_id").type)

    rows = known.select("doc_id", "digest", "match_id").mapInArrow(facts, schema).union(docs.mapInArrow(placed, schema))
    return rows.repartition("place").sortWithinPartitions("place", "tail", *order, "kind").mapInArrow(
        compared, f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                  f"near_edited double, near_next double, match_id {id_type}")


def _order(doc_id: object, text_digest: bytes) -> tuple:
    return doc_id is None, 0 if doc_id is None else doc_id, text_digest


class _Open:
    """A document that waits for the next one; the minima of what its edited form keeps are taken once."""

    def __init__(self, minhash: MinHash, key: tuple, doc_id: object, text: str, match: object):
        self.key, self.doc_id, self.text, self.match, self.rows = key, doc_id, text, match, 1
        self.keep = len(text) - len(text) // 4
        self.points = minhash.points(text)
        self.front = minhash.minima(self.points, 0, self.keep)
        self.minima = np.minimum(self.front, minhash.minima(self.points, self.keep, len(text)))

    def result(self, minhash: MinHash, after: _Open) -> tuple:
        head = after.text[:len(self.text) - self.keep]
        joined = np.r_[self.points[self.keep:self.keep + minhash.width - 1], minhash.points(head)[minhash.width - 1:]]
        edited = np.minimum(self.front, minhash.minima(joined, 0, len(head)))
        sha = hashlib.sha256((self.text[:self.keep] + head).encode()).hexdigest()
        return (self.doc_id, len(self.text), sha, spelled(self.minima), spelled(edited),
                likeness(self.minima, edited), likeness(self.minima, after.minima), self.match)


def _results(rows: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
    kinds = [ids, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), ids]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "match_id"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
