"""Phrases that occur together more often than their parts suggest, by the stripes pattern."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certflow.llm.keyfilter import key_filter, may_hold
from certflow.llm.near_dedup import mixed
from certflow.llm.tasks import as_bytes, steps, stored

SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"  # they end a piece
PIECES = bytes.maketrans(SEPARATORS + b"\x09", b"." * len(SEPARATORS) + b" ")
WORD_PARTS = 1 << 20
ROW_ENTRIES = 4096  # of the stripes in one row, which bounds the rows of a batch
LEAST_GROUPS, GROUP_WORDS = 4096, 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Numbers of words from 1 on; 0 stands for the end of a piece."""

    def __init__(self) -> None:
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def word_numbers(text: bytes | None, words: Words) -> np.ndarray:
    """The words of a text in order, A-Z lower-cased; a 0 after each piece."""
    tokens = (text or b"").lower().translate(PIECES).replace(b".", b" . ").split()
    tokens.append(b".")
    return np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))


def hashed(words: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def phrase_keys(langs: np.ndarray, *words: np.ndarray) -> np.ndarray:
    """64-bit keys of phrases, from the hashes of their languages and of their first, second, ... words."""
    key = langs
    for word in words:
        key = mixed(key * GOLDEN + word)
    return key


class Packs:
    """Texts of each language as numbers of words, gathered up to `chunk` words and then sent on."""

    def __init__(self, chunk: int):
        self.chunk = chunk
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, Words] = defaultdict(Words)
        self.held: dict[str, list[np.ndarray]] = defaultdict(list)
        self.size = 0

    def add(self, lang: str, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held[lang].append(numbers)
        self.size += len(numbers)
        if self.size >= self.chunk:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        for lang, held in self.held.items():
            names = b" ".join(list(self.words[lang])[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([names], pa.binary()), pa.array([np.concatenate(held).tobytes()], pa.binary())], ["lang", "names", "numbers"])
        self.clear()


PACK = "lang string, names binary, numbers binary"


def packed(docs: DataFrame, chunk: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs = Packs(chunk)
        for batch in steps(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
                yield from packs.add(lang, word_numbers(text, packs.words[lang]))
        yield from packs.sent()

    return docs.mapInArrow(pack, PACK)


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray, np.uint64]]:
    """Of each pack the language, the words by number, the numbers, the words' hashes, and the language's hash."""
    for batch in steps(batches, 1):
        row = batch.to_pylist()[0]
        names = [b".", *row["names"].split()]
        yield row["lang"], names, np.frombuffer(row["numbers"], np.int32), hashed(names, len(names)), np.uint64(xxhash.xxh3_64_intdigest(row["lang"].encode()))


def reduced(packs: DataFrame, table: Broadcast, chunk: int) -> DataFrame:
    """The packs with a piece ending where a word is too rare for any phrase, packed anew."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packs(chunk)
        for lang, names, numbers, hashes, own in _unpacked(batches):
            often = may_hold(table.value, phrase_keys(np.full(len(names), own), hashes))
            often[0] = False
            numbering = np.zeros(len(names), np.int32)
            for k in np.flatnonzero(often):
                numbering[k] = out.words[lang][names[k]]
            numbers = numbering[numbers]
            numbers = numbers[np.r_[True, (numbers[1:] > 0) | (numbers[:-1] > 0)]]
            if numbers.any():
                yield from out.add(lang, numbers)
        yield from out.sent()

    return packs.mapInArrow(reduce, PACK)


class Slices:
    """Into how many parts the stripe of a prefix is cut: one, but for the prefixes whose keys are listed."""

    def __init__(self, keys: np.ndarray, parts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.parts = keys[order], parts[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), np.uint64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.parts[at], 1).astype(np.uint64)


def everywhere(keys: np.ndarray) -> np.ndarray:
    """The parts of the empty prefix, whose stripe holds all words of a language."""
    return np.full(len(keys), WORD_PARTS, np.uint64)


# A row holds stripes of one group: prefixes joined by tabs, the entries of each (four bytes), all their next words joined
# by spaces, and the counts of these in one byte each, or in eight where they are larger.
STRIPES = "lang string, group long, prefixes string, sizes binary, next string, counts binary"


def _chunk_stripes(packs: DataFrame, m: int, table: Broadcast | None, slices: Broadcast, groups: int) -> DataFrame:
    """Stripes of each pack: for each prefix of `m` words a counter of its next words.

    Next words count only where the prefix and the phrase that ends in the next word can both be frequent. The
    prefix, and its slice by the hash of the next word if it has any, tell the group, the key of the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, names, numbers, hashes, own in _unpacked(batches):
            if m == 0:
                counts = np.bincount(numbers, minlength=len(names))
                counts[0] = 0
                after = np.flatnonzero(counts)
                counts, prefix = counts[after], np.zeros(len(after), np.int64)
                start, keys = prefix, np.full(len(after), own)
            else:
                if len(numbers) <= m:
                    continue
                inside = np.ones(len(numbers) - m + 1, bool)
                for k in range(m):
                    inside &= numbers[k:len(numbers) - m + 1 + k] > 0
                at = np.flatnonzero(inside)
                key = phrase_keys(np.full(len(at), own), *[hashes[numbers[at + k]] for k in range(m)])
                found = may_hold(table.value, key)
                inside[at] = found
                followed = np.zeros(len(inside), bool)
                followed[:-1] = inside[1:]
                found &= followed[at]
                at, key = at[found], key[found]
                prefix = numbers[at].astype(np.int64)
                for k in range(1, m):
                    prefix = np.unique(prefix * len(names) + numbers[at + k], return_inverse=True)[1]
                _, first, counts = np.unique(prefix * len(names) + numbers[at + m], return_index=True, return_counts=True)
                prefix, start, after, keys = prefix[first], at[first], numbers[at[first] + m], key[first]
            if len(after):
                group = (mixed(keys + hashes[after] % slices.value(keys) * GOLDEN) % np.uint64(groups)).astype(np.int64)
                yield from _stripe_rows(lang, pa.array(names, pa.binary()), numbers, m, prefix, start, after, counts, group)

    return packs.mapInArrow(count, STRIPES)


def _stripe_rows(
    lang: str, names: pa.Array, numbers: np.ndarray, m: int, prefix: np.ndarray, start: np.ndarray, after: np.ndarray, counts: np.ndarray, group: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Rows of STRIPES of up to ROW_ENTRIES entries; `start` is a place where the prefix stands in `numbers`."""
    large = counts > 255
    order = np.lexsort((prefix, group, large))
    prefix, start, after, counts, group = (c[order] for c in (prefix, start, after, counts, group))
    border = len(group) - int(large.sum())
    for first, last, kind in ((0, border, np.uint8), (border, len(group), np.int64)):
        if first == last:
            continue
        own = slice(first, last)
        new = np.r_[True, group[own][1:] != group[own][:-1]]
        run = np.flatnonzero(new)[np.cumsum(new) - 1]
        new |= (np.arange(last - first) - run) % ROW_ENTRIES == 0
        stripe = new.copy()
        stripe[1:] |= prefix[own][1:] != prefix[own][:-1]
        rows, stripes = np.flatnonzero(new), np.flatnonzero(stripe)
        at = start[own][stripes]
        spelled = pc.binary_join_element_wise(*[names.take(pa.array(numbers[at + j])) for j in range(m)], b" ") if m else pa.array([b""] * len(at), pa.binary())
        in_row = np.r_[np.searchsorted(stripes, rows), len(stripes)].astype(np.int32)
        entries = np.r_[rows, last - first].astype(np.int32)
        blob = lambda values, offsets: pa.Array.from_buffers(
            pa.binary(), len(rows), [None, pa.py_buffer(offsets * np.int32(values.itemsize)), pa.py_buffer(np.ascontiguousarray(values))])
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(rows), pa.string()), pa.array(group[own][rows], pa.int64()),
            pc.binary_join(pa.ListArray.from_arrays(pa.array(in_row), spelled), b"\t").cast(pa.string()),
            blob(np.diff(np.r_[stripes, last - first]).astype(np.int32), in_row),
            pc.binary_join(pa.ListArray.from_arrays(pa.array(entries), names.take(pa.array(after[own]))), b" ").cast(pa.string()),
            blob(counts[own].astype(kind), entries),
        ], ["lang", "group", "prefixes", "sizes", "next", "counts"])


def _merged(stripes: DataFrame, min_count: int, with_totals: bool) -> DataFrame:
    """Stripes of one group added up entry by entry: lang, prefix, next, a, of the entries of at least `min_count`.

    With totals, the sum of all entries of a group comes as well, in rows without `next`.
    """
    keys = ["lang", "group"]
    columns = [*keys, "prefix", "next", "counts"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: pa.Table | None = None  # entries of the last group, which may go on in the next rows
        for batch in steps(batches, 128):
            flat = _flat(batch)
            flat = pa.concat_tables([open_, flat]) if open_ is not None else flat
            flat = flat.group_by(columns[:-1], use_threads=False).aggregate([("counts", "sum")]).rename_columns(columns)
            last = pc.and_(*(pc.equal(flat.column(c), batch.column(c)[-1]) for c in keys))
            yield from closed(flat.filter(pc.invert(last)))
            open_ = flat.filter(last).combine_chunks()
        if open_ is not None:
            yield from closed(open_)

    def closed(flat: pa.Table) -> Iterator[pa.RecordBatch]:
        if with_totals:
            totals = flat.group_by(["lang"], use_threads=False).aggregate([("counts", "sum")])
            none = pa.nulls(len(totals), pa.string())
            yield from pa.table([totals.column("lang"), none, none, totals.column("counts_sum")], names=["lang", "prefix", "next", "a"]).to_batches()
        often = flat.filter(pc.greater_equal(flat.column("counts"), min_count))
        yield from often.select(["lang", "prefix", "next", "counts"]).rename_columns(["lang", "prefix", "next", "a"]).to_batches(max_chunksize=8192)

    return stripes.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge, "lang string, prefix string, next string, a long")


def _flat(batch: pa.RecordBatch) -> pa.Table:
    """The entries of rows of STRIPES: lang, group, prefix, next, counts."""
    listed = pc.split_pattern(batch.column("next"), " ")
    lengths = pc.list_value_length(listed).to_numpy()
    counts = [np.frombuffer(c, np.uint8 if len(c) == n else np.int64) for c, n in zip(batch.column("counts").to_pylist(), lengths)]
    sizes = np.concatenate([np.frombuffer(s, np.int32) for s in batch.column("sizes").to_pylist()])
    prefixes = pc.split_pattern(batch.column("prefixes"), "\t").flatten().take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
    parents = pc.list_parent_indices(listed)
    return pa.table({"lang": batch.column("lang").take(parents), "group": batch.column("group").take(parents), "prefix": prefixes,
                     "next": listed.flatten(), "counts": np.concatenate(counts).astype(np.int64)})


def _keys(phrases: DataFrame, m: int, *more: str) -> DataFrame:
    """Keys of phrases of `m` words, with the columns (of longs) `more`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words = hashed((w for phrase in as_bytes(batch.column("phrase")) for w in phrase.split(b" ")), n * m).reshape(n, m)
            keys = phrase_keys(hashed(as_bytes(batch.column("lang")), n), *words.T)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *(batch.column(c) for c in more)], ["key", *more])

    return phrases.select("lang", "phrase", *more).mapInArrow(run, ", ".join(f"{c} long" for c in ("key", *more)))


def _hot(level: DataFrame, m: int, slices: int, words: int) -> Slices:
    """Phrases that make up more than one in `slices` of all words, so fewer than `slices`, and the parts of their stripes."""
    hot = level.select("lang", "phrase", F.ceil(F.col("a") * F.lit(float(slices)) / F.lit(float(words))).alias("parts")).where("parts > 1")
    found = _keys(hot, m, "parts").toArrow()
    return Slices(found.column("key").to_numpy().view(np.uint64), found.column("parts").to_numpy())


def phrase_counts(docs: DataFrame, *, longest: int, min_count: int, slices: int, chunk: int, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """The frequent phrases of up to `longest` words, and the words of each language in all.

    phrases: lang, phrase, words (their number), a, prefix (its first words but the last).
    totals: lang, n.
    """
    context = docs.sparkSession.sparkContext
    packs, groups = packed(docs, chunk), LEAST_GROUPS
    totals, levels, table, cut = None, [], None, context.broadcast(everywhere)
    for m in range(longest):
        level = stored(_merged(_chunk_stripes(packs, m, table, cut, groups), min_count, with_totals=m == 0), f"stripes-{m}")
        entries = level.where("next IS NOT NULL")
        phrase = F.col("next") if m == 0 else F.concat_ws(" ", "prefix", "next")
        levels.append(entries.select("lang", phrase.alias("phrase"), F.lit(m + 1).alias("words"), "a", "prefix"))
        if m == 0:  # the stripe of the empty prefix counts all words
            totals = stored(level.where("next IS NULL").groupBy("lang").agg(F.sum("a").alias("n")), "totals")
            n = totals.agg(F.sum("n")).first()[0] or 0
            groups = max(LEAST_GROUPS, n // GROUP_WORDS)
        if m + 1 < longest:
            table = context.broadcast(key_filter(_keys(levels[-1], m + 1), "key", filter_bits))
            cut = context.broadcast(_hot(levels[-1], m + 1, slices, max(1, n)))
            if m == 0:  # texts are read once more, so that only what can be part of a phrase is stored
                packs = stored(reduced(packs, table, 4 * chunk), "phrase-packs", "zstd")
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.union(level)
    return phrases, totals


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", *, longest: int = 5, min_count: int = 100, top: int = 2000,
    slices: int = 20_000, chunk: int = 1 << 20, filter_bits: int = 24,
) -> DataFrame:
    """The best phrases of 2 to `longest` words of each language, by how far they exceed their parts.

    Pieces end at `. , ; : ! ?` and line ends, words at spaces and tabs; A-Z are lower-cased. With
    a = occurrences of a phrase, n = words of the language, a cut into the first words (l times)
    and the rest (r times) scores floor(1000 * a * n / (l * r)) in exact integers, and the
    lowest cut counts (the shortest first part on a tie). A phrase inside a longer one that
    occurs as often is left out. Returns lang, rank, phrase, a, l, r, n, score, the first `top` of each
    language by score, then a, both falling, then phrase in byte order.

    Stripes: each prefix of 0 to 4 words has a counter of its next words. Texts are packed as numbers of words in
    chunks of `chunk` words; a chunk counts its own stripes, and stripes of one prefix are added up after one
    shuffle, by groups of prefixes (4096, or one for each 2^20 words where there are more). The stripe of a prefix that makes up
    more than one in `slices` of all words is cut by the hash of the next word, into as many parts as its count
    asks for, so no prefix is the work of one task. The empty prefix gives n and the words; each stripe gives the counts of its
    extensions, and their maxima tell which phrases go on in a longer one as often. A phrase is
    as rare as its rarest part: the frequent phrases of one length go as a bit table of fixed
    size (2^filter_bits bits) to the tasks that count the next length, and rare words end a piece from then on. What passes
    the table by chance is counted and dropped, so a full table costs time and changes no result.

    A null lang counts as `und`, as does `und` itself; a null text is empty. Repeated rows count each. A text is taken whole
    by one task, whatever its length. An empty table gives no rows. Extra columns are ignored.
    """
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    phrases, totals = phrase_counts(docs, longest=longest, min_count=min_count, slices=slices, chunk=chunk, filter_bits=filter_bits)
    tail = F.col("phrase").substr(F.instr("phrase", " ") + 1, F.length("phrase"))
    longer = phrases.where("words > 2")
    # the most frequent extension on either side: a maximum over a stripe, and over those that share their last words
    maxima = (longer.select("lang", F.col("prefix").alias("phrase"), "a").union(longer.select("lang", tail.alias("phrase"), "a"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    whole = stored(phrases.where("words > 1").join(maxima, ["lang", "phrase"], "left")
                   .where("longer IS NULL OR longer < a").select("lang", "phrase", "words", "a"), "candidates")
    word = F.split("phrase", " ")
    cuts = (whole.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .withColumn("first", F.array_join(F.slice(word, F.lit(1), F.col("k")), " "))
            .withColumn("rest", F.array_join(F.slice(word, F.col("k") + 1, F.col("words")), " ")))
    count = lambda name, c: phrases.select("lang", F.col("phrase").alias(name), F.col("a").alias(c))
    scored = (stored(cuts, "cuts").join(count("first", "l"), ["lang", "first"]).join(count("rest", "r"), ["lang", "rest"])
              .join(totals, "lang").withColumn("score", _score()))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def _score() -> Column:
    """floor(1000 * a * n / (l * r)): a and n below 10^17 keep the products within 38 digits."""
    return F.expr("cast((1000 * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(17,0)) * cast(r as decimal(17,0))) as long)")
