"""What is left to do, as anti joins against what is done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from certflow.functions.scalars import not_blank
from certflow.operators.skew import HEAVY_ROWS, salted_join
from certflow.schemas import CALL_COLUMNS


def not_done(rows: DataFrame, done: DataFrame, keys: list[str], spread: str = "") -> DataFrame:
    """Rows whose key is not in `done`; rows with a null key stay.

    The done side is cut to distinct keys first: the partial aggregation removes
    copies map-side, so no key of it can be hot in the join, and the join uses the same
    exchange. By itself the row side must have (nearly) unique keys; `spread` "nulls" spreads
    many null keys as well, "keys" also keys that repeat very often.
    """
    have = done.select(*keys).distinct()
    if not spread:
        return rows.join(have, keys, "left_anti").select(*rows.columns)
    return salted_join(rows, have, keys, "left_anti", HEAVY_ROWS if spread == "keys" else None).select(*rows.columns)


def top(rows: DataFrame, order: list[str | Column], n: int | None) -> DataFrame:
    """The first n rows (TakeOrderedAndProject: n rows per task, no full sort)."""
    return rows.orderBy(*order).limit(n) if n is not None else rows


def next_rows(rows: DataFrame, done: DataFrame, keys: list[str], n: int | None) -> DataFrame:
    """The rows of the first n keys that are not done, for rows that carry long texts.

    With a limit only the keys go through the anti join and the top n; the keys picked then
    select the whole rows where they lie, so no text passes a single task. Repeated rows of a
    picked key come together.
    """
    if n is None:
        return not_done(rows, done, keys)
    picked = top(not_done(rows.select(*keys), done, keys), keys, n).distinct()
    return rows.join(picked, keys, "left_semi").select(*rows.columns)


def new_records(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows that are not stored yet; many of them may have no key."""
    return not_done(rows, stored, [key], "nulls")


def prompts_long(prompts: DataFrame, versions: list[str]) -> DataFrame:
    """One row per file and prompt version; a version is a column of the prompt table."""
    return prompts.select("FILE_ID", *versions).unpivot("FILE_ID", versions, "prompt_version", "prompt_text")


def prompt_worklist(
    prompts: DataFrame, answers: DataFrame, version: str | list[str], n: int | None = None
) -> DataFrame:
    """Prompts that are not blank and not answered in their version, by file id."""
    versions = [version] if isinstance(version, str) else version
    wanted = prompts_long(prompts, versions).filter(not_blank(F.col("prompt_text"))).select(
        F.col("FILE_ID").alias("file_id"), "prompt_text", "prompt_version"
    )
    done = answers.select("file_id", F.col("PromptVersion").alias("prompt_version"))
    return next_rows(wanted, done, ["file_id", "prompt_version"], n)


def api_worklist(certificates: DataFrame, log: DataFrame, n: int | None = None) -> DataFrame:
    """Certificates without any log row yet, with the eight call parameters."""
    return top(not_done(certificates.select(*CALL_COLUMNS), log, ["CertificateID"]), ["CertificateID"], n)


def url_worklist(
    urls: DataFrame, inventory: DataFrame, log: DataFrame, n: int | None = None
) -> DataFrame:
    """Distinct valid URLs whose file is not on disk and not downloaded with success.

    `urls` has attest_url and expected_filename; one of several names per URL is kept
    by value, so a run gives the same list each time.
    """
    distinct = (
        urls.filter(F.col("attest_url").rlike("^https?://"))
        .groupBy("attest_url")
        .agg(F.min("expected_filename").alias("expected_filename"))
    )
    loaded = log.filter(F.col("status") == "Success")
    left = not_done(distinct, loaded, ["attest_url"])
    on_disk = inventory.select(F.col("filename").alias("expected_filename"))
    return top(not_done(left, on_disk, ["expected_filename"], "keys"), ["attest_url"], n)


def extract_worklist(inventory: DataFrame, extracts: DataFrame, n: int | None = None) -> DataFrame:
    """PDF files without an extract, by name."""
    pdf = inventory.filter(F.lower("file_extension") == ".pdf")
    return top(not_done(pdf, extracts, ["file_id"]), ["filename", "file_id"], n)


def clean_worklist(extracts: DataFrame, cleaned: DataFrame, n: int | None = None) -> DataFrame:
    """Extracts without a cleaned text."""
    return next_rows(extracts, cleaned, ["file_id"], n)


def new_files(listing: DataFrame, inventory: DataFrame, skip_existing: bool = True) -> DataFrame:
    """Listed files whose name is not in the inventory, or all of them when forced."""
    return not_done(listing, inventory, ["filename"], "keys") if skip_existing else listing


def gone_files(inventory: DataFrame, listing: DataFrame) -> DataFrame:
    """Inventory rows whose path is not listed any more; a null path counts as gone."""
    return not_done(inventory, listing, ["full_path"], "nulls")
