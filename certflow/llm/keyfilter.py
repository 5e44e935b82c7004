"""A bit table of fixed size over 64-bit keys: tells tasks what can be left out, never what must stay."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = (0, 20, 40)  # each probe reads a window of bits of the key from here on


def key_filter(keys: DataFrame, column: str, bits: int = 24) -> np.ndarray:
    """The table of the long keys in `column`, as 2^bits bits in words of 64.

    Spark joins the bits by word, so the driver receives 2^bits / 64 words at most, whatever
    the number of keys. A full table only stops leaving things out; nothing depends on it.
    """
    at = [F.shiftrightunsigned(F.col(column), p).bitwiseAND(F.lit(2**bits - 1)) for p in PROBES]
    word = (keys.select(F.explode(F.array(*at)).alias("at"))
            .groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")))
    found = word.toArrow()
    table = np.zeros(2**bits // 64, np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False where a key is surely not among those of the table."""
    mask = np.uint64(len(table) * 64 - 1)
    found = np.ones(len(keys), bool)
    for p in PROBES:
        at = (keys >> np.uint64(p)) & mask
        found &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found
