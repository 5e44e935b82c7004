"""CSV files of any size read in parallel, also where quoted fields hold line ends.

A file is landed as chunks of whole lines. Whether a chunk begins inside a quoted field depends
on all bytes before it, so each chunk first tells only how it would end from either state; these
small functions are composed over the file, block by block, and then every chunk is cut into
records by itself. Records that cross chunks are put together from their fragments.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from certflow.schemas import CERTIFICATE_COLUMNS, CERTIFICATE_KEY

CHUNK_BYTES = 1 << 20
SEPARATORS = [",", ";", "\t"]  # fixed values: the separators to try, in order
HEAD_LINES = 6  # the header and the sample rows of a dialect
OUTSIDE, INSIDE = 0, 1  # of a quoted field


class Grammar:
    """Patterns of one separator. A quote opens a field only at the field's begin and closes at the first one that is not doubled."""

    def __init__(self, separator: str):
        self.separator = separator
        sep = re.escape(separator.encode())
        field = rb'(?<=[' + sep + rb'\n])"[^"]*+(?:""[^"]*+)*+"'
        quote = rb'(?<![' + sep + rb'\n])"'
        # each is matched at a place behind a line feed that is put before the data
        self.closed = re.compile(rb'(?:[^"]++|' + field + rb'|' + quote + rb')*+')
        self.record = re.compile(rb'(?:[^"\n]++|' + field + rb'|' + quote + rb')*+')
        self.over_lines = re.compile(rb'(?<=[' + sep + rb'\n])"[^"\n]*+(?:""[^"\n]*+)*+\n')
        self.close = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')

    def after(self, data: bytes, state: int) -> int:
        """The state at the end of `data`, which begins with a line feed, from a state behind that."""
        at = 1
        if state == INSIDE:
            found = self.close.match(data, at)
            if not found:
                return INSIDE
            at = found.end()
        return OUTSIDE if self.closed.match(data, at).end() == len(data) else INSIDE

    def cut(self, data: bytes, state: int) -> tuple[bytes | None, list[bytes], bytes | None]:
        """What ends the record that is open at the begin, the whole records, and what opens one at the end."""
        data, at, head = b"\n" + data, 1, None
        if state == INSIDE:
            found = self.close.match(data, at)
            end = self.record.match(data, found.end()).end() if found else len(data)
            if end < len(data) and data[end] != 10:
                end = len(data)  # the record opens a further field that this chunk does not close
            head, at = data[at:end + 1], end + 1
        if b'"' not in data[at:]:
            lines = data[at:].split(b"\n")
            return head, lines[:-1] if not lines[-1] else lines, None
        records = []
        while at < len(data):
            end = self.record.match(data, at).end()
            if end < len(data) and data[end] != 10:
                return head, records, data[at:]
            records.append(data[at:end])
            at = end + 1
        return head, records, None


    def field_counts(self, data: bytes, n: int) -> list[int]:
        """Numbers of fields of the first `n` records that are not blank; what the data cut short counts as it is."""
        data, at, counts = b"\n" + data, 1, []
        while at < len(data) and len(counts) < n:
            end = self.record.match(data, at).end()
            if end < len(data) and data[end] != 10:
                end = len(data)
            if data[at:end].strip():
                counts.append(len(fields_of(data[at:end].decode("latin-1"), self.separator)))
            at = end + 1
        return counts


@lru_cache(len(SEPARATORS))
def grammar(separator: str) -> Grammar:
    return Grammar(separator)


_CHUNK = ("path string, block long, chunk int, data binary, utf8 boolean, physical_lines long, ends array<int>, "
          "over_lines array<boolean>, header binary, fields array<array<int>>")


def chunks_of(spark: SparkSession, paths: str | list[str], where: Column | None = None, recursive: bool = True) -> DataFrame:
    """Chunks of whole lines of the files below `paths`, in one scan.

    path, block (where the scan's split begins), chunk (its number in the split), data; whether it is valid UTF-8, its
    lines that are not blank, `ends` (the state after it from OUTSIDE and from INSIDE, for each separator),
    over_lines (whether a quoted field holds a line end, for each separator). The first chunk of a file also has its
    first line and, for each separator, the number of fields of its first records. `where` may choose files by `_metadata`, which Spark does before it opens them.
    """
    raw = spark.read.option("recursiveFileLookup", recursive).option("lineSep", "\n").text(paths)
    if where is not None:
        raw = raw.where(where)
    lines = raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_block_start").alias("block"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, number, filled = None, [], 0, 0, 0
        for batch in batches:
            for value, path, block in zip(*(batch.column(c).to_pylist() for c in ("value", "path", "block"))):
                if key != (path, block) or size >= CHUNK_BYTES and filled >= HEAD_LINES:
                    if held:
                        yield _chunk(key, number, held)
                    number = number + 1 if key == (path, block) else 0
                    key, held, size, filled = (path, block), [], 0, 0
                held.append(value)
                size += len(value) + 1
                filled += filled < HEAD_LINES and bool(value.strip())
        if held:
            yield _chunk(key, number, held)

    return lines.mapInArrow(gather, _CHUNK)


def _chunk(key: tuple[str, int], number: int, lines: list[bytes]) -> pa.RecordBatch:
    data = b"\n".join(lines) + b"\n"
    quoted = b'"' in data
    after = [g.after(b"\n" + data, s) if quoted else s for g in map(grammar, SEPARATORS) for s in (OUTSIDE, INSIDE)]
    over = [bool(quoted and grammar(s).over_lines.search(b"\n" + data)) for s in SEPARATORS]
    try:
        data.decode("utf-8")
        utf8 = True
    except UnicodeDecodeError:
        utf8 = False
    filled = [x for x in lines if x.strip()]
    is_first = key[1] == 0 and number == 0 and bool(filled)
    header = filled[0].removesuffix(b"\r") if is_first else None
    fields = [grammar(s).field_counts(data, HEAD_LINES) for s in SEPARATORS] if is_first else None
    return pa.RecordBatch.from_arrays([
        pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([number], pa.int32()), pa.array([data], pa.binary()),
        pa.array([utf8]), pa.array([len(filled)], pa.int64()), pa.array([after], pa.list_(pa.int32())), pa.array([over], pa.list_(pa.bool_())),
        pa.array([header], pa.binary()), pa.array([fields], pa.list_(pa.list_(pa.int32())))],
        ["path", "block", "chunk", "data", "utf8", "physical_lines", "ends", "over_lines", "header", "fields"])


def _running(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Compose the functions `f0`, `f1` (the state after a row from OUTSIDE and from INSIDE) in order.

    A function either keeps the state, swaps it, or ends in the same state from both. So what comes
    before a row is told by the last row of the third kind and the number of swaps since. Adds
    g0, g1: the state before each row, from either state before its first; h0, h1: that after it.
    """
    window = Window.partitionBy(*keys).orderBy(order)
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.col("f0") == F.col("f1"), F.col("f0"))
    rows = rows.withColumn("swaps", F.sum((F.col("f0") > F.col("f1")).cast("int")).over(upto))
    for name, frame in (("g", before), ("h", upto)):
        last, swaps = F.last(fixed, True).over(frame), F.coalesce(F.last("swaps").over(frame), F.lit(0))
        at = F.last(F.when(fixed.isNotNull(), F.col("swaps")), True).over(frame)
        for state in (OUTSIDE, INSIDE):
            rows = rows.withColumn(f"{name}{state}", (F.coalesce(last, F.lit(state)) + swaps - F.coalesce(at, F.lit(0))) % 2)
    return rows


def chunk_states(chunks: DataFrame, dialects: DataFrame) -> DataFrame:
    """path, block, chunk with the dialect of the file, and whether the chunk begins and ends inside a quoted field.

    Only numbers move. Chunks are composed within their block first and blocks within their file,
    so a window holds the chunks of one block or the blocks of one file.
    """
    sep = F.array_position(F.array(*[F.lit(s) for s in SEPARATORS]), F.col("separator")).cast("int")
    found = chunks.select("path", "block", "chunk", "ends").join(dialects.select("path", "separator", "encoding", "header"), "path").select(
        "path", "block", "chunk", "separator", "encoding", "header", F.col("ends")[2 * sep - 2].alias("f0"), F.col("ends")[2 * sep - 1].alias("f1"))
    inner = _running(found, ["path", "block"], "chunk")
    whole = inner.groupBy("path", "block").agg(F.max_by("h0", "chunk").alias("f0"), F.max_by("h1", "chunk").alias("f1"))
    start = _running(whole, ["path"], "block").select("path", "block", F.col("g0").alias("start"))
    pick = lambda x: F.when(F.col("start") == OUTSIDE, F.col(f"{x}0")).otherwise(F.col(f"{x}1"))
    return inner.join(start, ["path", "block"]).select(
        "path", "block", "chunk", "separator", "encoding", "header", pick("g").alias("begins"), pick("h").alias("ends"))


def present_columns(dialects: DataFrame) -> list[str]:
    """The known columns that the header of any file names."""
    names = F.transform(F.split("header", F.col("separator")), lambda n: F.btrim(n, F.lit('"')))
    known = F.array_intersect(names, F.array(*[F.lit(c) for c in CERTIFICATE_COLUMNS]))
    found = {r[0] for r in dialects.select(F.explode(known)).distinct().collect()}
    return [c for c in CERTIFICATE_COLUMNS if c in found]


def records_of(chunks: DataFrame, dialects: DataFrame) -> DataFrame:
    """The records of the chunks' files as strings: the known columns, and for each row

    overflow (the first field beyond the header), keyed (the file has the key column), unclosed (a quoted field is
    still open at the end of the file), source_path, source_block, source_row. Empty fields are
    null. Records without anything but white space are left out, as are files that `dialects` lacks or
    whose header names no known column. `chunks` is read twice and should be a stored table.

    A chunk goes with its dialect through one join, which Spark does as it sees fit: no path or
    header passes through the driver. A record that crosses chunks must fit in memory.
    """
    columns = present_columns(dialects)
    if not columns:
        raise ValueError("no file has any of the expected columns")
    names = F.transform(F.split("header", F.col("separator")), lambda n: F.btrim(n, F.lit('"')))
    states = chunk_states(chunks, dialects.where(F.arrays_overlap(names, F.array(*[F.lit(c) for c in columns]))))
    at = ["path", "block", "chunk"]
    data = chunks.select(*at, "data").join(states, at)
    schema = ", ".join([*(f"`{c}` string" for c in columns),
                        "overflow string, keyed boolean, unclosed boolean, source_path string, source_block long, source_row long"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            records = grammar(row["separator"]).cut(row["data"], row["begins"])[1]
            yield _parsed(row, [(k, r, False) for k, r in enumerate(records)], columns)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            head, _, tail = grammar(row["separator"]).cut(row["data"], row["begins"])
            found = [(opens, x) for opens, x in ((False, head), (True, tail)) if x is not None]
            yield pa.RecordBatch.from_pylist(
                [{**{k: row[k] for k in (*at, "separator", "encoding", "header")}, "opens": opens, "data": x} for opens, x in found], _FRAGMENT)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            parts = sorted(row["parts"], key=lambda p: (p["block"], p["chunk"], p["opens"]))
            row |= {"block": parts[0]["block"], "chunk": parts[0]["chunk"]}
            record = b"".join(p["data"] for p in parts)
            unclosed = grammar(row["separator"]).after(b"\n" + record, OUTSIDE) == INSIDE
            yield _parsed(row, [(2**31, record.removesuffix(b"\n"), unclosed)], columns)

    inside = data.where("separator IS NOT NULL").mapInArrow(whole, schema)
    parts = data.where((F.col("begins") == INSIDE) | (F.col("ends") == INSIDE)).mapInArrow(
        fragments, "path string, block long, chunk int, separator string, encoding string, header string, opens boolean, data binary")
    in_file = Window.partitionBy("path").orderBy("block", "chunk", "opens")
    parts = parts.withColumn("record", F.sum(F.col("opens").cast("int")).over(in_file))
    across = parts.groupBy("path", "record", "separator", "encoding", "header").agg(
        F.collect_list(F.struct("block", "chunk", "opens", "data")).alias("parts")).mapInArrow(joined, schema)
    return inside.unionByName(across)


_FRAGMENT = pa.schema([("path", pa.string()), ("block", pa.int64()), ("chunk", pa.int32()), ("separator", pa.string()), ("encoding", pa.string()),
                       ("header", pa.string()), ("opens", pa.bool_()), ("data", pa.binary())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):  # one at a time: a row holds a chunk
            yield batch.slice(k, 1).to_pylist()[0]


@lru_cache(1000)
def _places(header: str, separator: str) -> tuple[int, dict[str, int]]:
    """Fields of a header, and where each name stands first."""
    names = next(csv.reader([header], delimiter=separator))
    return len(names), {n: names.index(n) for n in names}


def fields_of(record: str, separator: str) -> list[str]:
    """The fields of one record by the rules of Grammar; the csv module would end a record at a lone carriage return."""
    out, at = [], 0
    while True:
        held = ""
        if record.startswith('"', at):
            end = at + 1
            while (end := record.find('"', end)) >= 0 and record.startswith('""', end):
                end += 2
            stop = end if end >= 0 else len(record)
            held, at = record[at + 1:stop].replace('""', '"'), min(stop + 1, len(record))
        end = record.find(separator, at)
        out.append(held + record[at:end if end >= 0 else len(record)])
        if end < 0:
            return out
        at = end + len(separator)


def _parsed(row: dict, records: list[tuple[int, bytes, bool]], columns: list[str]) -> pa.RecordBatch:
    separator, n_names = row["separator"], 0
    n_names, places = _places(row["header"], separator)
    # Latin-1 has a character for each byte; a broken byte in a file of UTF-8 can't be, as the dialect says so
    decoded = [(k, r.decode(row["encoding"], "replace").removesuffix("\r"), u) for k, r, u in records]
    if row["block"] == 0 and row["chunk"] == 0:
        decoded = [(k, r.removeprefix("﻿"), u) for k, r, u in decoded]
        decoded = [x for x in decoded if x[1].strip()][1:] if any(k < 2**31 for k, _, _ in decoded) else decoded
    decoded = [x for x in decoded if x[1].strip()]
    csv.field_size_limit(sys.maxsize)
    plain = [r for _, r, u in decoded if "\r" not in r and not u]
    quick = csv.reader(plain, delimiter=separator)
    split = [next(quick) if "\r" not in r and not u else fields_of(r, separator) for _, r, u in decoded]
    out = {c: [(f[places[c]] or None) if places[c] < len(f) else None for f in split] if c in places else [None] * len(split) for c in columns}
    out["overflow"] = [f[n_names] if len(f) > n_names else None for f in split]
    out["keyed"] = [CERTIFICATE_KEY in places] * len(split)
    out["unclosed"] = [u for _, _, u in decoded]
    out["source_path"] = [row["path"]] * len(split)
    out["source_block"] = [row["block"]] * len(split)
    out["source_row"] = [(row["chunk"] << 32) + k for k, _, _ in decoded]
    kinds = {"keyed": pa.bool_(), "unclosed": pa.bool_(), "source_block": pa.int64(), "source_row": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()], list(out))
