"""Stupid-backoff scores of documents against the n-gram counts of all other documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from certflow.llm.near_dedup import WordHashes, mixed
from certflow.llm.tasks import as_bytes, give_back, groups, steps, stored

BATCH_BYTES = 6 << 20
PART_BYTES = 8 << 20


def planes(values: np.ndarray, kind: type = np.uint64) -> bytes:
    """Bytes of integers, first all lowest bytes, then the next: the shuffle's compression then drops zero bytes."""
    return values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def from_planes(data: bytes, kind: type = np.uint64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Numbers(dict):
    """Numbers of words, in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Grams:
    """The n-grams of a batch of documents: ranks of each position, and hashes and counts of each rank."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, vocabulary: np.ndarray, order: int):
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.ranks: list[np.ndarray] = []  # by n: rank of the n-gram that ends at each position, -1 at a document's start
        self.hashes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        for n in range(1, order + 1):
            ranks = np.full(len(tokens), -1, np.int32)
            at = np.flatnonzero(place >= n - 1)
            if n == 1:
                used, inverse, count = np.unique(tokens, return_inverse=True, return_counts=True)
                hashes = mixed(vocabulary[used])
            else:
                codes = self.ranks[-1][at - 1].astype(np.int64) * len(vocabulary) + tokens[at]
                used, inverse, count = np.unique(codes, return_inverse=True, return_counts=True)
                hashes = mixed(self.hashes[-1][used // len(vocabulary)] * np.uint64(0x9E3779B97F4A7C15) + vocabulary[used % len(vocabulary)] + np.uint64(n))
            ranks[at] = inverse
            self.ranks.append(ranks)
            self.hashes.append(hashes)
            self.counts.append(count)

    def by_part(self, n: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the n-grams by hash, and where each part begins: parts are equal ranges of the hash."""
        order = np.argsort(self.hashes[n - 1])
        part = (self.hashes[n - 1][order] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        return order, np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))

    def own(self, n: int) -> np.ndarray:
        """Times that each position's n-gram occurs in its own document."""
        ranks = self.ranks[n - 1]
        _, inverse, count = np.unique(self.doc.astype(np.int64) * (len(self.counts[n - 1]) + 1) + ranks, return_inverse=True, return_counts=True)
        return count[inverse]


def _grams(row: dict, order: int) -> Grams:
    return Grams(from_planes(row["tokens"], np.int32), np.frombuffer(row["sizes"], np.int64),
                 np.frombuffer(row["vocabulary"], np.uint64), order)


def scores(grams: Grams, totals: list[np.ndarray], n_docs: int, corpus_words: int, backoff: float) -> np.ndarray:
    """Sum of the logarithms of the scores of each document's words.

    All counts leave out the word's own document. A word's score is count(n-gram) /
    count(context) at the highest order whose count is not 0, times `backoff` for each order
    given up; a word that no other document has gets 1 / (words of the others + 1).
    """
    sizes = np.bincount(grams.doc, minlength=n_docs)
    others = (corpus_words - sizes)[grams.doc].astype(np.float64)
    before: np.ndarray | None = None
    log = np.empty(0)
    for n in range(1, len(totals) + 1):
        ranks = grams.ranks[n - 1]
        count = np.where(ranks >= 0, totals[n - 1][ranks] if len(totals[n - 1]) else 0, 0).astype(np.int64)
        count = np.where(ranks >= 0, count - grams.own(n), 0)
        if n == 1:
            log = np.where(count > 0, np.log(np.maximum(count, 1)) - np.log(np.maximum(others, 1)), -np.log(others + 1))
        else:
            context = np.r_[1, before[:-1]]
            log = np.where(count > 0, np.log(np.maximum(count, 1)) - np.log(np.maximum(context, 1)),
                           np.where(ranks >= 0, np.log(backoff), 0.0) + log)
        before = count
    return np.bincount(grams.doc, log, n_docs).astype(np.float64)


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, order: int = 2, backoff: float = 0.4,
    batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """doc_id, n_words, log_score (sum over words) and mean_log_score of each whole text, words with A-Z lower-cased.

    Counts come from all documents; a document's own words are taken off before it is scored (see scores).

    Documents are packed in batches of about batch_bytes of text (a longer text is one by itself). A batch explodes into its
    distinct n-grams, which are joined to the count table by parts of their hash: one row for each batch
    and part holds the hashes of that part, sorted, with the batch's counts. A part adds up the
    counts of each hash over all batches and answers each batch with those of the other
    batches; the batch sums the logarithms by document. A frequent n-gram is one entry of a batch, so no part is heavy, and parts and
    batches keep their size as the input grows: only their numbers do, and with them the tasks.

    Null and empty texts have 0 words and null scores. Rows are kept one for one, also repeated
    ones, which count as documents of their own; extra columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    arrow_kind = to_arrow_type(source.schema["doc_id"].dataType)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        part = TaskContext.get().partitionId()
        local = Numbers()
        ids, texts, held, number = [], [], 0, 0  # words become numbers as they are read, so no list of words outlives its text

        def packed() -> pa.RecordBatch:
            tokens = np.concatenate(texts)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | number], pa.int64()), pa.array([ids], pa.list_(arrow_kind)),
                pa.array([np.fromiter(map(len, texts), np.int64, len(texts)).tobytes()], pa.binary()),
                pa.array([planes(tokens, np.int32)], pa.binary()),
                pa.array([np.fromiter(map(hashes.__getitem__, local), np.uint64, len(local)).tobytes()], pa.binary()),
                pa.array([len(tokens)], pa.int64())], ["batch", "ids", "sizes", "tokens", "vocabulary", "n"])

        for batch in steps(batches):
            for one, value in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                ids.append(one)
                words = (value or b"").lower().split()
                texts.append(np.fromiter(map(local.__getitem__, words), np.int32, len(words)))
                held += len(value or b"")
                if held >= batch_bytes:
                    yield packed()
                    local = Numbers()
                    ids, texts, held, number = [], [], 0, number + 1
                    give_back()
        if ids:
            yield packed()
        give_back()

    packs = stored(source.mapInArrow(pack, f"batch long, ids array<{kind}>, sizes binary, tokens binary, vocabulary binary, n long"), "packs", "zstd")
    n_packs, total = packs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = max(1, -(-total * 8 * order // part_bytes))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1):
            for row in batch.to_pylist():
                grams = _grams(row, order)
                for n in range(1, order + 1):
                    by_part, starts = grams.by_part(n, parts)
                    rows = []
                    for p in range(parts):
                        at = by_part[starts[p]:starts[p + 1]]
                        if len(at):
                            rows.append({"part": p * order + n - 1, "batch": row["batch"], "n": n, "hashes": planes(np.diff(grams.hashes[n - 1][at], prepend=np.uint64(0))),
                                         "counts": planes(grams.counts[n - 1][at])})
                    yield pa.RecordBatch.from_pylist(rows, _ASKED)
                del grams, rows
                give_back()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "part"):
            hashes = [np.cumsum(from_planes(r["hashes"]), dtype=np.uint64) for r in rows]
            _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
            counts = np.concatenate([from_planes(r["counts"]) for r in rows]).astype(np.int64)
            others = np.bincount(inverse, counts).astype(np.int64)[inverse] - counts  # exact below 2 ** 53
            ends = np.cumsum([len(h) for h in hashes])
            for r, h, end in zip(rows, hashes, ends):
                yield pa.RecordBatch.from_pylist([{"batch": r["batch"], "n": r["n"], "part": r["part"], "others": planes(others[end - len(h):end])}], _ANSWERED)
            del hashes, inverse, counts, others
            give_back()

    asked = packs.select("batch", "sizes", "tokens", "vocabulary").mapInArrow(explode, "part long, batch long, n int, hashes binary, counts binary")
    answers = asked.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(count, "batch long, n int, part long, others binary")
    none = F.lit(None)
    both = packs.select("batch", F.lit(0).alias("n"), F.lit(-1).cast("long").alias("part"), none.cast("binary").alias("others"), "ids", "sizes", "tokens", "vocabulary").union(
        answers.select("batch", "n", "part", "others", none.cast(f"array<{kind}>"), none.cast("binary"), none.cast("binary"), none.cast("binary")))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "batch"):
            first, rest = rows[0], rows[1:]
            grams = _grams(first, order)
            totals = []
            for n in range(1, order + 1):
                by_part, _ = grams.by_part(n, parts)
                found = [from_planes(r["others"]) for r in rest if r["n"] == n]
                sums = grams.counts[n - 1].astype(np.int64)
                if found:
                    sums[by_part] += np.concatenate(found).astype(np.int64)
                totals.append(sums)
            sizes = np.frombuffer(first["sizes"], np.int64)
            logs = scores(grams, totals, len(sizes), total, backoff)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first["ids"], arrow_kind), pa.array(sizes), pa.array(logs, mask=sizes == 0)], ["doc_id", "n_words", "log_score"])
            del rows, first, rest, grams, totals
            give_back()

    scored = both.repartition(max(1, n_packs), "batch").sortWithinPartitions("batch", "n", "part").mapInArrow(
        finish, f"doc_id {kind}, n_words long, log_score double")
    return scored.withColumn("mean_log_score", F.col("log_score") / F.nullif(F.col("n_words"), F.lit(0)))


_ASKED = pa.schema([("part", pa.int64()), ("batch", pa.int64()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
_ANSWERED = pa.schema([("batch", pa.int64()), ("n", pa.int32()), ("part", pa.int64()), ("others", pa.binary())])
