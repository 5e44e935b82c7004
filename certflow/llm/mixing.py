"""Mixing sources to target weights by fixed-length blocks and per-source index permutations."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from certflow.llm.near_dedup import mixed
from certflow.llm.tasks import WORD, steps, stored

STREAM_WORDS = 1 << 20
GROUP_STREAMS = 1024
_word = re.compile(WORD)


def word_count(text: Column) -> Column:
    """Runs of characters other than 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_repeats: int = 3) -> DataFrame:
    """Target words per source: columns source, source_size, source_index, target.

    `sizes` has source and size. Sources by code point, null last, weigh 1, 2, 3, repeating.
    They share the sum of all sizes by weight; a target stops at max_repeats times its
    source's size, and what is left is shared anew until none is above. The windows hold one row
    of a few numbers per source, never rows of documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_index")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    return (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("source_index", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.col("source_index") % 3 + 1)
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("total", F.sum("source_size").over(everything))
        # In order of cap / weight, a source is at its cap as long as the level of those from it on is above that ratio.
        .withColumn("level", level)
        .withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
        .withColumn("shared", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
        .select("source", "source_size", "source_index",
                F.when(F.col("open"), F.least(F.col("cap"), F.col("shared") * F.col("weight")))
                .otherwise(F.col("cap")).cast("double").alias("target"))
    )


def packed_blocks(docs: DataFrame, block_words: int) -> DataFrame:
    """Pieces of documents in blocks: source_index, block, row, first, last.

    `docs` has row (a key), place (a hash of the content), source_index, source_size and size. Each
    source is dealt by place over streams of about 2 ** 20 words; a stream lays its documents end to
    end, by place, and is cut every block_words words, the last block being shorter. Blocks of a source are numbered over
    its streams through two running sums, so no window holds more than a stream's documents,
    1024 streams, or one row for each 1024 streams of a source. first and last are word
    positions inside the document, last excluded.
    """
    streams = F.ceil(F.col("source_size") / STREAM_WORDS)
    dealt = docs.where("size > 0").withColumn("stream", F.pmod(F.xxhash64("place"), streams))
    in_order = Window.partitionBy("source_index", "stream").orderBy("place", "row")
    laid = dealt.withColumn("start", F.sum("size").over(in_order) - F.col("size"))
    counts = stored(dealt.groupBy("source_index", "stream").agg(F.sum("size").alias("words"))
                    .withColumn("n", F.ceil(F.col("words") / block_words))
                    .withColumn("part", F.expr(f"stream div {GROUP_STREAMS}")), "streams")
    parts = counts.groupBy("source_index", "part").agg(F.sum("n").alias("m"))
    earlier = Window.partitionBy("source_index").orderBy("part")
    parts = parts.withColumn("base", F.sum("m").over(earlier) - F.col("m"))
    inside = Window.partitionBy("source_index", "part").orderBy("stream")
    firsts = (counts.withColumn("before", F.sum("n").over(inside) - F.col("n")).join(parts, ["source_index", "part"])
              .select("source_index", "stream", (F.col("base") + F.col("before")).alias("first_block")))
    low = F.expr(f"start div {block_words}")
    high = F.expr(f"(start + size - 1) div {block_words}")
    cut = laid.withColumn("k", F.explode(F.sequence(low, high)))
    return cut.join(firsts, ["source_index", "stream"]).select(
        "source_index", (F.col("first_block") + F.col("k")).alias("block"), "row",
        F.greatest(F.lit(0), F.col("k") * block_words - F.col("start")).alias("first"),
        F.least(F.col("size"), (F.col("k") + 1) * block_words - F.col("start")).alias("last"))


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(size) at `index`: four Feistel rounds, walked until inside."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mixed(np.arange(1, 5, dtype=np.uint64) + np.full(4, key, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mixed(right + k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def shard_draw(slots: np.ndarray, shard: int, per_shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Source and rank within the source of each slot of one shard.

    A pseudorandom permutation of all slots of the mix deals them out to shards. The counts of
    sources in a shard are so a multinomial draw under the condition that all shards together
    use each source's slots exactly; any shard finds its own draw alone, at any number of slots.
    """
    ends = np.cumsum(slots)
    total = int(ends[-1])
    place = permuted(np.arange(shard * per_shard, min(total, (shard + 1) * per_shard)), total, seed)
    source = np.searchsorted(ends, place, side="right")
    return source, place - (ends - slots)[source]


def drawn_slots(spark: SparkSession, quotas: np.ndarray, per_shard: int, seed: int) -> DataFrame:
    """Slots of the mix: shard, slot, source_index, block.

    The rows of `quotas` are source_index, number of blocks and number of slots, by source. Slot j of a
    source takes block permutation(j mod blocks) of the source's (j div blocks)-th permutation,
    so each block is used once before any is used again.
    """
    quotas = quotas[:, quotas[2] > 0]
    shards = -(-int(quotas[2].sum()) // per_shard)
    shared = spark.sparkContext.broadcast(quotas)  # 24 bytes per source

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, blocks, slots = shared.value
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                source, rank = shard_draw(slots, shard, per_shard, seed)
                block = np.empty(len(source), np.int64)
                for k in np.unique(source):
                    for turn in np.unique(rank[source == k] // blocks[k]):
                        at = (source == k) & (rank // blocks[source] == turn)
                        key = seed * 1_000_003 + int(index[k]) * 101 + int(turn)
                        block[at] = permuted(rank[at] % blocks[k], int(blocks[k]), key)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(source), shard)), pa.array(np.arange(len(source))),
                    pa.array(index[source]), pa.array(block)], ["shard", "slot", "source_index", "block"])

    return spark.range(shards).mapInArrow(draw, "shard long, slot long, source_index long, block long")


def numbered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """The rows as a table in the shared folder.

    Columns: own (a struct of all columns of `docs`, or of `keep`, so that none can clash),
    mix_source, size (words), row (a key) and place (a hash of id and text, which neither files nor tasks change).
    """
    own = F.struct(*[docs[f"`{c}`"] for c in (docs.columns if keep is None else keep)])
    return stored(docs.select(
        own.alias("own"), F.col(source).alias("mix_source"), word_count(F.col(text)).alias("size"),
        F.monotonically_increasing_id().alias("row"), F.xxhash64(F.col(doc_id), F.col(text)).alias("place")), "mix-rows")


def mix(
    rows: DataFrame, *, block_words: int = 128, shard_blocks: int = 1024, max_repeats: int = 3, seed: int = 11,
) -> tuple[DataFrame, DataFrame]:
    """Mix whole sources to their targets (see source_targets); `rows` comes from numbered().

    Returns two tables. The first has source_index, mix_source, source_size and target of each source. The
    second is the mix: shard, slot, source_index, block, row, first, last: a slot's block is
    made of the words first to last (excluded) of its rows, in order of row. A source gets
    target * blocks / source_size slots, rounded, so its words come near its target and no
    block, and so no word, is used more than max_repeats times.

    Null and empty texts have size 0 and are never taken. All rows of a null source form one
    source. Repeated rows are rows of their own. Reruns agree, over other files and with other tasks too: the
    draw depends on the seed, ids and texts; only rows that are equal in both can change places. Three
    numbers per source come to the driver and go to the tasks that draw.
    """
    spark = rows.sparkSession
    targets = stored(source_targets(rows.select(F.col("mix_source").alias("source"), "size"), max_repeats)
                     .withColumnRenamed("source", "mix_source"), "targets")
    sized = rows.select("row", "place", "size", "mix_source").join(
        targets.withColumnRenamed("mix_source", "name"), F.col("mix_source").eqNullSafe(F.col("name"))
    ).select("row", "place", "size", "source_size", "source_index")
    pieces = stored(packed_blocks(sized, block_words), "pieces")
    blocks = pieces.groupBy("source_index").agg((F.max("block") + 1).alias("blocks"))
    listed = targets.join(blocks, "source_index").select(
        F.col("source_index").cast("long").alias("source_index"), "blocks",
        F.bround(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long").alias("slots")).orderBy("source_index").toArrow()
    quotas = np.array([c.to_numpy() for c in listed.columns], np.int64)
    if quotas[2].any():
        slots = drawn_slots(spark, quotas, shard_blocks, seed)
    else:
        slots = spark.createDataFrame([], "shard long, slot long, source_index long, block long")
    # Spark takes the slots for as few as the shards that they come from and would send them to all executors
    return targets, slots.hint("merge").join(pieces, ["source_index", "block"])


def taken_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **settings: int) -> DataFrame:
    """Words that the mix takes of each row, repeats counted: doc_id, size, source_size, target, taken."""
    rows = numbered(docs, doc_id, text, source, [doc_id])
    targets, pieces = mix(rows, **settings)
    taken = pieces.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    named = targets.withColumnRenamed("mix_source", "name")
    return (rows.join(taken, "row", "left").join(named, F.col("mix_source").eqNullSafe(F.col("name")))
            .select(F.col("own").getField(doc_id).alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", n_chars: str | None = "n_chars", **settings: int,
) -> DataFrame:
    """The mix as rows with the columns of `docs`, whose text is what the mix takes.

    Where the mix takes a document's words k times, there are k turns; each turn gives a row for
    each run of neighbouring words that it takes, from the run's first character to its last, or the text as
    it is if the run holds all words. n_chars counts anew. Documents that are not taken have no row.
    """
    own = docs.columns
    rows = numbered(docs, doc_id, text, source)
    _, pieces = mix(rows, **settings)
    uses = (pieces.groupBy("row", "first", "last").agg(F.count("*").alias("times"))
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "last", "times"))).alias("uses")))
    taken = rows.join(uses, "row").select("own", "size", "uses")
    at = own.index(text)
    count_at = own.index(n_chars) if n_chars in own else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            index, texts = [], []
            wholes = batch.column("own").field(at).to_pylist()
            for k, (whole, size, uses) in enumerate(zip(wholes, *(batch.column(c).to_pylist() for c in ("size", "uses")))):
                places = [m.span() for m in _word.finditer(whole)]
                for first, last in runs(uses):
                    index.append(k)
                    texts.append(whole if last - first == size else whole[places[first][0]:places[last - 1][1]])
            columns = batch.column("own").take(pa.array(index, pa.int64())).flatten()
            columns[at] = pa.array(texts, columns[at].type)
            if count_at is not None:
                columns[count_at] = pa.array([len(x) for x in texts], pa.int64()).cast(columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=own)

    return taken.mapInArrow(cut, docs.schema)


def runs(uses: list[dict]) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring pieces for each turn: pieces used more than t times belong to turn t."""
    for turn in range(max((u["times"] for u in uses), default=0)):
        held: tuple[int, int] | None = None
        for u in uses:
            if u["times"] <= turn:
                continue
            if held and held[1] == u["first"]:
                held = held[0], u["last"]
            else:
                if held:
                    yield held
                held = u["first"], u["last"]
        if held:
            yield held
