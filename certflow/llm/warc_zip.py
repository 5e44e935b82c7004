"""WARC records in ZIP packages: written by Spark's text writer, read by ranges without extraction."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certflow.llm.tasks import as_bytes, stored

LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
BIG = 0xFFFFFFFF
RUN_BYTES = 4 << 20
READ_BYTES = 16 << 20
DATE = "2025-01-01T00:00:00Z"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: object, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: object) -> bytes:
    """A response or, with payload None, a revisit record, whose HTTP head keeps the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in url))
    if payload is None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = http + (payload or b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Fields of one record: page_id, record_type, refers_to, payload (None for a revisit), payload_bytes, payload_digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]):
        raise ValueError("a record ends before its content does")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    name = lambda x: None if x is None or x == "<urn:page:None>" else x[len("<urn:page:"):-1]
    out = {"page_id": name(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
           "refers_to": name(fields.get("WARC-Refers-To"))}
    if fields["WARC-Type"] == "response":
        if len(payload) != length or f"sha1:{_digest(payload)}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
        return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": _digest(payload)}
    return out | {"payload": None, "payload_bytes": length, "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:")}


# ---- ZIP structures

def _wide(zip64: bool, *values: int) -> tuple[list[int], bytes]:
    """Values for 32-bit fields, and the ZIP64 extra field for those that don't fit (all of them if asked)."""
    over = [v for v in values if zip64 or v >= BIG]
    shown = [BIG if zip64 or v >= BIG else v for v in values]
    return shown, struct.pack("<HH", 1, 8 * len(over)) + b"".join(struct.pack("<Q", v) for v in over) if over else b""


def local_head(name: str) -> bytes:
    """Head of a stored member whose sizes and checksum follow in a data descriptor; it ends in a line feed."""
    extra = struct.pack("<HHQQ", 1, 16, 0, 0) + struct.pack("<HH", 0x4E4C, 1) + b"\n"  # ZIP64, and a private field
    raw = name.encode()
    return LOCAL + struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 33, 0, BIG, BIG, len(raw), len(extra)) + raw + extra


def descriptor(crc: int, size: int) -> bytes:
    return b"PK\7\x08" + struct.pack("<IQQ", crc, size, size)


def directory(members: list[tuple[str, int, int, int]], start: int, zip64: bool) -> bytes:
    """Central directory of (name, offset, size, crc), ZIP64 end and locator where needed, and the end with a comment of one line feed."""
    out = b""
    for name, offset, size, crc in members:
        (size_, size2_, offset_), extra = _wide(zip64, size, size, offset)
        raw = name.encode()
        out += CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, 33, crc, size_, size2_, len(raw), len(extra), 0, 0, 0, 0, offset_) + raw + extra
    size, end = len(out), start + len(out)
    if zip64 or end >= BIG or len(members) >= 0xFFFF:
        out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(members), len(members), size, start)
        out += LOCATOR64 + struct.pack("<IQI", 0, end, 1)
        return out + END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, BIG, BIG, 1) + b"\n"
    return out + END + struct.pack("<HHHHIIH", 0, 0, len(members), len(members), size, start, 1) + b"\n"


def members_of(read, length: int) -> list[dict]:
    """Members of a ZIP file by `read(offset, size)`: name, method, offset of the data, packed size.

    Finds the end record behind a comment of up to 65,535 bytes, follows the ZIP64 locator, and takes
    64-bit values from the extra field where a 32-bit field is full.
    """
    tail_at = max(0, length - 65_557 - 20)
    tail = read(tail_at, length - tail_at)
    at = tail.rfind(END, 0, len(tail) - 18)
    while at >= 0 and tail_at + at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != length:
        at = tail.rfind(END, 0, at + 3)
    if at < 0:
        raise ValueError("not a ZIP file")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != END64:
            raise ValueError("the ZIP64 end record is missing")
        count, size, start = struct.unpack_from("<QQQ", end64, 32)
    listed, out, k = read(start, size), [], 0
    for _ in range(count):
        if listed[k:k + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", listed, k + 10)
        crc, packed, plain, n, m, c = struct.unpack_from("<IIIHHH", listed, k + 16)
        offset, = struct.unpack_from("<I", listed, k + 42)
        name, extra = listed[k + 46:k + 46 + n].decode(), listed[k + 46 + n:k + 46 + n + m]
        e = 0
        while e + 4 <= len(extra):
            kind, size_ = struct.unpack_from("<HH", extra, e)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{size_ // 8}Q", extra, e + 4))
                plain = next(wide) if plain == BIG else plain
                packed = next(wide) if packed == BIG else packed
                offset = next(wide) if offset == BIG else offset
            e += 4 + size_
        out.append({"name": name, "method": method, "crc": crc, "size": packed, "head": offset})
        k += 46 + n + m + c
    for x in out:
        n, m = struct.unpack_from("<HH", read(x["head"], 30), 26)
        x["offset"] = x["head"] + 30 + n + m
    return out


class Ranges:
    """Byte ranges of a file in a store that pyarrow knows: local or mounted, hdfs, s3, gs."""

    def __init__(self, path: str):
        from pyarrow import fs

        parts = urlsplit(path)
        if parts.scheme in ("", "file"):
            self.file = fs.LocalFileSystem().open_input_file(parts.path)
        else:
            store, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            self.file = store.open_input_file(inner)

    def __call__(self, offset: int, size: int) -> bytes:
        data = self.file.read_at(size, offset)
        if len(data) != size:
            raise ValueError("a range lies beyond the end of the file")
        return data

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()


# ---- writing

def planned(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest and, for a revisit, refers_to.

    Among payloads that are equal (by SHA-256) and hold least_bytes or more, the smallest
    page_id is the response that the others refer to. Copies are merged before the shuffle; the
    smallest ids are stored and joined back, so that Spark can split a payload of very many pages.
    A null html is an empty payload. A row without a page_id is a response of its own, and so is each
    of several rows with the smallest id.
    """
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    large = F.octet_length("html") >= least_bytes
    alone = F.concat_ws("-", F.lit("small"), "page_id", F.xxhash64("html"))
    source = source.withColumn("same", F.when(large, F.sha2("html", 256)).otherwise(alone))
    first = stored(source.where(large).groupBy("same").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                   .where("n > 1 and first_id is not null").drop("n"), "first-pages")
    return source.join(first, "same", "left").select(
        "page_id", "url", F.col("html"),
        F.when(F.col("page_id") != F.col("first_id"), F.col("first_id")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, *, zip64: bool = False) -> None:
    """Write planned() rows as ZIP files below `path`, one for each partition, through Spark's text writer and its commit.

    A ZIP holds the stored members archive/data.warc and indexes/index.cdx; an index line has page_id,
    offset inside the member, and length. The writer ends each row with a line feed, so bytes
    are handed over in pieces that end in one: heads by a private extra field, records by their
    own end, the file by a comment of one line feed. Nothing but the index of a file is held in memory.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = local_head("archive/data.warc")
        at = crc = 0
        index: list[bytes] = []
        send = lambda pieces: pa.RecordBatch.from_arrays([pa.array([p[:-1] for p in pieces], pa.binary())], ["value"])
        begun = False
        for batch in batches:
            pieces = [] if begun else [head]
            begun = True
            for one, url, html, other in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), as_bytes(batch.column("html")), batch.column("refers_to").to_pylist()):
                made = record(one, url, html if other is None else None, len(html), _digest(html), other)
                index.append(b"%s %d %d\n" % (str(one).encode(), at, len(made)))
                at += len(made)
                crc = zlib.crc32(made, crc)
                pieces.append(made)
            yield send(pieces)
        if not begun:
            return
        listed = b"".join(index)
        index_at = len(head) + at + len(descriptor(0, 0))
        index_head = local_head("indexes/index.cdx")
        tail = descriptor(crc, at) + index_head
        rest = listed + descriptor(zlib.crc32(listed), len(listed)) + directory(
            [("archive/data.warc", 0, at, crc), ("indexes/index.cdx", index_at, len(listed), zlib.crc32(listed))],
            index_at + len(index_head) + len(listed) + len(descriptor(0, 0)), zip64)
        yield send([tail, rest])

    packed = records.mapInArrow(pack, "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


# ---- reading

def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """path, name, offset and size of each member of the ZIP files below `path`; packed archives and indexes are an error when read."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length in zip(*(c.to_pylist() for c in batch.columns)):
                with Ranges(file) as read:
                    found = members_of(read, length)
                yield pa.RecordBatch.from_pylist(
                    [{"path": file, "name": x["name"], "offset": x["offset"], "size": x["size"], "stored": x["method"] == 0} for x in found], _MEMBERS)

    return files.mapInArrow(listed, "path string, name string, offset long, size long, stored boolean")


_MEMBERS = pa.schema([("path", pa.string()), ("name", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("stored", pa.bool_())])
_RANGES = pa.schema([("path", pa.string()), ("member", pa.int64()), ("offset", pa.int64()), ("size", pa.int64())])
_RANGE_TYPES = "path string, member long, offset long, size long"


def record_ranges(members: DataFrame) -> DataFrame:
    """path, offset in the file, and size of runs of records of every archive member.

    Indexes are read in ranges of RUN_BYTES, each by the task that its first byte falls to; a
    range owns the lines that begin in it. A line belongs to the archive that it names; a line without a name to
    the archive that is called like its index, or to a ZIP's only one. Neighbouring records make runs of up to
    RUN_BYTES. An archive whose index lines don't tile it, each byte once, is walked from record to record by one task
    instead, so no record hangs on an index. Packed members, and ZIP files without an archive member, are an error.
    """
    is_archive = F.col("name").startswith("archive/") & ~F.col("name").endswith("/")
    is_index = F.col("name").startswith("indexes/") & ~F.col("name").endswith("/")
    found = members.groupBy("path").agg(
        F.collect_list(F.when(is_archive, F.struct("name", "offset", "size"))).alias("archives"),
        F.collect_list(F.when(is_index, F.struct("name", "offset", "size"))).alias("indexes"),
        F.min(F.when((is_archive | is_index) & ~F.col("stored"), F.col("name"))).alias("packed"))
    packages = stored(found.where(
        F.assert_true(F.col("packed").isNull(), F.concat(F.lit("packed member "), "packed", F.lit(" in "), "path")).isNull()
        & F.assert_true(F.size("archives") > 0, F.concat(F.lit("no archive member in "), "path")).isNull()), "packages")
    parts = packages.select("path", "archives", F.explode("indexes").alias("index")).where("index.size > 0").select(
        "path", "archives", "index", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("index.size - 1"), F.lit(RUN_BYTES).cast("long"))).alias("from"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, archives, index, first in zip(*(c.to_pylist() for c in batch.columns)):
                owner = _owners(archives, index["name"])
                with Ranges(file) as read:
                    lines = _lines(read, index["offset"], index["size"], first, RUN_BYTES)
                    entries = filter(None, map(index_entry, lines))
                    placed = ((owner[name], offset, size) for name, offset, size in entries if name in owner)
                    yield _runs(file, ((at, at + offset, size) for at, offset, size in placed))

    spread = parts.repartition(_tasks(packages.select(F.explode("indexes.size").alias("size")), "size"), "path", "index", "from")
    indexed = stored(spread.mapInArrow(runs, _RANGE_TYPES), "indexed-runs")
    # runs tile a member exactly if all borders between them cancel out
    border = lambda c: F.xxhash64(c).cast("decimal(38,0)")
    tiles = indexed.groupBy("path", "member").agg(F.sum(border(F.col("offset")) - border(F.col("offset") + F.col("size"))).alias("borders"))
    archives = stored(
        packages.select("path", F.explode("archives").alias("a")).select("path", F.col("a.offset").alias("member"), F.col("a.size").alias("bytes"))
        .where("bytes > 0").join(tiles, ["path", "member"], "left")
        .withColumn("tiled", F.coalesce(F.col("borders") == border(F.col("member")) - border(F.col("member") + F.col("bytes")), F.lit(False))), "archives")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, at, size in zip(*(c.to_pylist() for c in batch.columns)):
                with Ranges(file) as read:
                    yield _runs(file, ((at, at + offset, n) for offset, n in walked(lambda k, n: read(at + k, n), size)))

    loose = archives.where("not tiled").select("path", "member", "bytes")
    alone = loose.repartition(_tasks(loose, "bytes"), "path", "member").mapInArrow(walk, _RANGE_TYPES)
    covered = indexed.join(archives.where("tiled").select("path", "member"), ["path", "member"], "left_semi")
    return covered.select("path", "offset", "size").union(alone.select("path", "offset", "size"))


def _tasks(rows: DataFrame, size: str) -> int:
    """One task for each READ_BYTES of what the rows stand for."""
    return 1 + int((rows.agg(F.sum(size)).first()[0] or 0) // READ_BYTES)


def _runs(file: str, records: Iterator[tuple[int, int, int]]) -> pa.RecordBatch:
    """Runs of neighbouring records (member, offset, size)."""
    out: list[dict] = []
    for member, offset, size in records:
        last = out[-1] if out else None
        if last and last["member"] == member and last["offset"] + last["size"] == offset and last["size"] + size <= RUN_BYTES:
            last["size"] += size
        else:
            out.append({"path": file, "member": member, "offset": offset, "size": size})
    return pa.RecordBatch.from_pylist(out, _RANGES)


def _owners(archives: list[dict], index: str) -> dict[str | None, int]:
    """Offset of an archive's data by each name that an index line can give it; None stands for lines without a name."""
    stem = lambda name: name.rsplit("/", 1)[-1].split(".warc")[0].split(".cdx")[0]
    short = [a["name"].rsplit("/", 1)[-1] for a in archives]
    out: dict = {n: a["offset"] for n, a in zip(short, archives) if short.count(n) == 1}
    out |= {a["name"].removeprefix("archive/"): a["offset"] for a in archives} | {a["name"]: a["offset"] for a in archives}
    alike = archives if len(archives) == 1 else [a for a in archives if stem(a["name"]) == stem(index)]
    return out | {None: alike[0]["offset"]} if len(alike) == 1 else out


def index_entry(line: bytes) -> tuple[str | None, int, int] | None:
    """Archive name, offset and length of an index line: ours, CDX or CDXJ; None for other lines."""
    try:
        if line.rstrip().endswith(b"}"):
            fields = json.loads(line[line.index(b"{"):])
            name, offset, size = fields.get("filename"), int(fields["offset"]), int(fields["length"])
        else:
            words = line.decode("utf-8", "surrogatepass").rstrip("\r").split(" ")
            if words[-1].isdigit():
                name, offset, size = None, int(words[-2]), int(words[-1])
            else:
                name, offset, size = words[-1], int(words[-2]), int(words[-3])
    except (ValueError, KeyError, IndexError, TypeError):
        return None
    return (name, offset, size) if offset >= 0 and size > 0 else None


def walked(read, size: int, step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Offset and size of each record of a member; `read(offset, size)` is relative to the member."""
    at = 0
    while at < size:
        data = read(at, min(65_536, size - at))
        if data[:2] == b"\x1f\x8b":
            one, end = zlib.decompressobj(wbits=31), at
            while not one.eof:
                if end >= size:
                    raise ValueError("a record ends before its content does")
                piece = read(end, min(step, size - end))
                end += len(piece)
                while piece and not one.eof:
                    one.decompress(piece, step)
                    piece = one.unconsumed_tail
            end -= len(one.unused_data)
        else:
            if data[:5] != b"WARC/":
                raise ValueError("no record begins where one should")
            while (head := data.find(b"\r\n\r\n")) < 0 and at + len(data) < size:
                data += read(at + len(data), min(len(data), size - at - len(data)))
            if head < 0:
                raise ValueError("a record ends before its head does")
            end = at + head + 4 + _content_length(data[:head]) + 4
            if end > size:
                raise ValueError("a record ends before its content does")
        yield at, end - at
        at = end


def _content_length(head: bytes) -> int:
    return next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.startswith(b"Content-Length:"))


def _lines(read, at: int, size: int, first: int, step: int) -> Iterator[bytes]:
    """Lines of a member that begin in [first, first + step)."""
    start = max(0, first - 1)
    data, end = read(at + start, min(size, first + step) - start), min(size, first + step)
    while end < size and not data.endswith(b"\n"):
        more = read(at + end, min(4096, size - end))
        cut = more.find(b"\n")
        data, end = (data + more, end + len(more)) if cut < 0 else (data + more[:cut + 1], size)
    lines = data.split(b"\n")
    if lines and lines[-1] == b"":
        lines.pop()
    return iter(lines[1:] if first else lines)


def read_records(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Records of the archives below `path`: page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest.

    Files are listed and their directories parsed in tasks; runs of records are dealt over all
    tasks and read by ranges; nothing is unpacked. Digests and lengths of responses are
    computed from the payload and compared with the record's head. A record that is a gzip member of its own is
    inflated alone. Every archive member is read, with or without an index; records about the crawl (warcinfo,
    request, metadata) give no row.
    """
    ranges = stored(record_ranges(archive_members(spark, path)), "ranges")
    # a row of a few bytes stands for a run of the archive: the number of tasks follows the bytes that the rows stand for
    ranges = ranges.repartition(_tasks(ranges, "size"), "path", "offset")

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, offset, size in zip(*(c.to_pylist() for c in batch.columns)):
                with Ranges(file) as read:
                    rows = [parsed(x) for x in split_records(read(offset, size)) if holds_page(x)]
                yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    found = ranges.mapInArrow(read_all, _RECORD_TYPES)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def split_records(data: bytes) -> Iterator[bytes]:
    """The records of a run; gzip members are inflated one by one."""
    if data[:2] == b"\x1f\x8b":
        while data:
            one = zlib.decompressobj(wbits=31)
            yield from split_records(one.decompress(data) + one.flush())
            data = one.unused_data
        return
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        end = head + 4 + _content_length(data[at:head]) + 4
        yield data[at:end]
        at = end


def holds_page(data: bytes) -> bool:
    """False for records about the crawl, which have no page."""
    head = data[:data.index(b"\r\n\r\n")].split(b"\r\n")
    return not any(x in (b"WARC-Type: warcinfo", b"WARC-Type: request", b"WARC-Type: metadata") for x in head)


_RECORD_TYPES = "page_id string, url string, record_type string, refers_to string, payload binary, payload_bytes long, payload_digest string"
_RECORDS = pa.schema([(n, {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[k]) for n, k in (x.split() for x in _RECORD_TYPES.split(", "))])
