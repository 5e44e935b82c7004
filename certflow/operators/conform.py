"""From raw strings to typed, de-duplicated certificate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from certflow.functions.text import strip
from certflow.schemas import CERTIFICATE_COLUMNS, DATETIME_COLUMNS, NUMERIC_COLUMNS, STRING_COLUMNS

# What a CSV reader of the source system takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
DATE_FORMATS = ["dd.MM.yyyy", "dd.MM.yyyy HH:mm:ss", "yyyy/MM/dd"]
_ISO_DATE = r"^\d{4}(-\d{1,2}(-\d{1,2}([ T].*)?)?)?$"
_NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def to_number(c: Column) -> Column:
    """Double, null for anything that is not a plain finite number (Java would take '12d', and '1e999' as infinite)."""
    text = strip(c)
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def to_time(c: Column) -> Column:
    """Timestamp from ISO text or one of the local formats, else null; a time without a date is null."""
    text = strip(c)
    local = [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]
    return F.coalesce(F.when(text.rlike(_ISO_DATE), text.try_cast("timestamp")), *local)


def to_text(c: Column) -> Column:
    """Missing tokens to null, then stripped; white space only becomes ''."""
    stripped = strip(c)
    return F.when(~c.isin(NA_TOKENS) & (stripped != "nan"), stripped)


def conform(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P1-P7 in one projection: the known columns typed, rows without any value dropped.

    `keep` names further columns, such as the position in the file, that pass through.
    """
    known = [c for c in CERTIFICATE_COLUMNS if c in raw.columns]
    if not known:
        raise ValueError("no expected column in the input")
    out = []
    for name in known:
        c = F.col(name)
        if name in NUMERIC_COLUMNS:
            c = to_number(c)
        elif name in DATETIME_COLUMNS:
            c = to_time(c)
        elif name in STRING_COLUMNS:
            c = to_text(c)
            if name == "BeregnetFossilandel":
                c = F.translate(c, ",", ".")  # P5
            elif name == "HarEnergiVurdering":
                c = F.initcap(F.lower(c))
                c = F.when(c.isin("True", "False"), c)  # P6
        out.append(c.alias(name))
    return raw.select(*out, *(keep or [])).dropna(how="all", subset=known)


def keep_first(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key; rows with a null key form one group.

    Spark cuts each task's rows down to one per key before the exchange
    (WindowGroupLimit), so a key with very many copies stays cheap.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank")


def keep_latest(rows: DataFrame, keys: list[str], *latest_first: Column) -> DataFrame:
    """The newest row of each key; pass descending orders with a tie break."""
    return keep_first(rows, keys, list(latest_first))
