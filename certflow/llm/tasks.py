"""Helpers for the Python parts of the operators: tables in the shared folder, Arrow batches, words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from certflow.session import scratch_dir

# The words of a text are the runs of bytes that bytes.split() returns: all but 0x20 and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write `df` as a table in the shared folder and read it back; this cuts its lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def steps(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in steps of a few rows, which bound what Python holds at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between stages, beside the JVM of their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim:
        trim(0)


def groups(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """Rows of neighbouring equal `keys`, gathered over batch borders; the input is sorted by them."""
    held: list[dict] = []
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]  # one at a time: rows may be large
            if held and any(row[key] != held[0][key] for key in keys):
                yield held
                held = []
            held.append(row)
    if held:
        yield held
