"""Cleaning of extracted text: X1-X12.

All rules work on the whole text at once with multi-line patterns instead of
splitting it into an array of lines, so a cleaning chain stays a short run of
`regexp_replace` calls. `(?d)` makes a newline the only line end.

Two rules of the source system can never match and are left out: the form-feed
line patterns (the character is removed before) and the hyphen repair (it needs
a newline inside one line).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from certflow.functions.binding import bind

# The white space that Python's str.strip and `\s` know, without
# and with the newline. Java's own classes are narrower.
BLANK_CHARS = (
    "\t\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CHARS = "\n" + BLANK_CHARS
# The same set as a character class: one property and some single characters,
# because every further range costs time at each character of the text.
_B = r"\p{Z}\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85"
BLANK = f"[{_B}]"
SPACE = rf"[\n{_B}]"
NON_SPACE = rf"[^\n{_B}]"
# Letters, digits and underscore but no combining marks.
WORD_CLASS = r"\p{L}\p{N}_"
WORD = f"[{WORD_CLASS}]"
DIGIT = r"\p{Nd}"
EOL = r"(?=\n|\z)"

# Line patterns that mark page artefacts.
PAGE_ARTEFACTS = [
    rf"{DIGIT}+{BLANK}*{EOL}",
    rf"Page{BLANK}+{DIGIT}+{BLANK}*{EOL}",
    rf"{DIGIT}+{BLANK}*/{BLANK}*{DIGIT}+{BLANK}*{EOL}",
    rf"[\-_=]{{3,}}{BLANK}*{EOL}",
    rf"[•·▪▫■□▲△▼▽◆◇○●★☆]+{BLANK}*{EOL}",
    rf"(?:https?://|www\.){NON_SPACE}",
    rf"(?={WORD})[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}"
    rf"(?:(?<=[A-Za-z])(?!{WORD})|(?<=\|)(?={WORD}))",
]
# Line patterns that mark repeated headers and footers.
HEADERS_FOOTERS = [
    rf"(?:confidential|proprietary|draft|internal){BLANK}*{EOL}",
    r"©",
    rf"{DIGIT}{{1,2}}[-/]{DIGIT}{{1,2}}[-/]{DIGIT}{{2,4}}{BLANK}*{EOL}",
]

MIN_RAW_CHARS = 10
MIN_CLEAN_CHARS = 5
MIN_LINE_BASIC = 3
MIN_LINE_AGGRESSIVE = 10
MIN_BLOCK_CHARS = 20
DUPLICATE_WINDOW = 10
LINES_PER_CHUNK = 256


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def _nfkd_udf():
    """Defined inside a function so that it is shipped by value and executors need no import.

    A worker of an Arrow UDF holds 10,000 texts at a time, in several copies; rows that are pickled come by the hundred.
    """

    def normalise(text):
        return None if text is None else unicodedata.normalize("NFKD", text)

    return F.udf(normalise, StringType(), useArrow=False)


def nfkd(c: Column) -> Column:
    """Compatibility decomposition. Spark has no built-in for it.

    ASCII text is its own decomposition, so only other rows travel to Python;
    the rest pass as nulls.
    """
    ascii_only = F.octet_length(c) == F.length(c)
    return F.coalesce(_nfkd_udf()(F.when(~ascii_only, c)), c)


def drop_control_chars(c: Column) -> Column:
    """Remove control characters, keep tab, newline and carriage return."""
    return F.regexp_replace(c, r"[^ -~\u00a0-\x{10ffff}\t\n\r]", "")


def drop_artefact_lines(c: Column, artefacts: bool = True, headers: bool = True) -> Column:
    """Drop each line that starts, after its indent, with one of the patterns.

    The same pass makes lines of white space only truly empty, which tells them
    apart from lines that later lose all their text.
    """
    patterns = (PAGE_ARTEFACTS if artefacts else []) + (HEADERS_FOOTERS if headers else [])
    rule = f"{BLANK}+{EOL}"
    if patterns:
        rule += rf"|{BLANK}*(?:{'|'.join(patterns)})[^\n]*(?:\n|\z)"
    return F.regexp_replace(c, f"(?imud)^(?:{rule})", "")


def drop_lines_matching(c: Column, patterns: list[str]) -> Column:
    """drop lines whose stripped form starts with one of the caller's patterns.

    The caller's patterns know nothing of the surrounding lines, so here the
    text is split; blank lines stay.
    """
    rule = rf"(?iud)\A(?:{'|'.join(f'(?:{p})' for p in patterns)})"
    kept = F.filter(F.split(c, "\n"), lambda x: ~strip(x).rlike(rule) | (strip(x) == ""))
    return F.array_join(kept, "\n")


def repair_lines(c: Column) -> Column:
    """Collapse blanks, split `aB`, space after `.!?`, isolated symbol to blank."""
    c = F.regexp_replace(c, r"[ \t]{2,}", " ")
    c = F.regexp_replace(c, r"[A-Z](?<=[a-z].)", " $0")
    # `\G`: a letter that closed the last match does not open the next one
    c = F.regexp_replace(c, rf"([.!?])(?<={WORD}.)({WORD})(?<!\G..)", "$1 $2")
    return F.regexp_replace(c, rf"{BLANK}+[^{WORD_CLASS}\n{_B}]{BLANK}+", " ")


def drop_short_lines(c: Column, minimum: int) -> Column:
    """Drop lines whose stripped length is below `minimum`; empty lines stay."""
    if minimum < 1:
        return c
    body = ""
    if minimum == 2:
        body = f"(?:{NON_SPACE})?"
    elif minimum > 2:
        body = rf"(?:{NON_SPACE}(?:[^\n]{{0,{minimum - 3}}}{NON_SPACE})?)?"
    return F.regexp_replace(c, rf"(?md)^(?!\n|\z){BLANK}*{body}{BLANK}*(?:\n|\z)", "")


def drop_empty_lines(c: Column) -> Column:
    """Remove blank lines."""
    return F.regexp_replace(c, r"\n{2,}", "\n")


def collapse_whitespace(c: Column) -> Column:
    """At most one blank line in a row (single pass), no blanks before a line end."""
    c = F.regexp_replace(c, rf"\n{SPACE}*\n{SPACE}*\n", "\n\n")
    return F.regexp_replace(c, rf"{BLANK}+{EOL}", "")


def clean_lines(
    c: Column,
    *,
    min_line_length: int = MIN_LINE_BASIC,
    preserve_structure: bool = True,
    artefacts: bool = True,
    headers: bool = True,
    collapse: bool = True,
    extra_patterns: list[str] | None = None,
) -> Column:
    """X2-X8 in order; a null text becomes an empty one."""
    c = drop_control_chars(F.coalesce(c, F.lit("")))
    if extra_patterns:
        c = drop_lines_matching(c, extra_patterns)
    c = drop_artefact_lines(c, artefacts, headers)
    c = repair_lines(c)
    c = drop_short_lines(c, min_line_length)
    if not preserve_structure:
        c = drop_empty_lines(c)
    if collapse:
        c = collapse_whitespace(c)
    return strip(c)


def line_tokens(line: Column) -> Column:
    """The set of lower-cased words of a line."""
    words = F.split(F.lower(line), f"{SPACE}+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two token sets, 0 when either is empty."""
    shared = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / whole)


def drop_repeated_lines(c: Column, threshold: float = 0.9) -> Column:
    """Drop a line too similar to one of the last ten kept lines.

    Blank lines are kept and take a place in the window. The fold carries the kept
    lines and the token sets of the window. Each step copies the lines kept so far,
    so lines are folded in chunks and the work stays linear for very long texts.
    """
    entries = F.transform(
        F.split(c, "\n"), lambda x: F.struct(x.alias("line"), line_tokens(x).alias("tokens"))
    )
    no_lines = F.array().cast("array<string>")

    def step(acc: Column, x: Column) -> Column:
        n = F.size(x["tokens"])

        def similar(seen: Column) -> Column:
            # the share is at most the ratio of the sizes, so most pairs need no intersection
            m = F.size(seen)
            possible = (m > 0) & (F.least(n, m) >= F.greatest(n, m) * threshold)
            return F.when(possible, jaccard(x["tokens"], seen) > threshold).otherwise(F.lit(False))

        window = F.concat(acc["window"], F.array(x["tokens"]))
        first = F.greatest(F.size(acc["window"]) + 2 - DUPLICATE_WINDOW, F.lit(1))
        grown = F.struct(
            F.concat(acc["kept"], F.array(x["line"])).alias("kept"),
            F.slice(window, first, DUPLICATE_WINDOW).alias("window"),
        )
        return F.when((n > 0) & F.exists(acc["window"], similar), acc).otherwise(grown)

    def fold_chunk(acc: Column, chunk: Column) -> Column:
        begin = F.struct(no_lines.alias("kept"), acc["window"].alias("window"))
        return bind(
            F.aggregate(chunk, begin, step),
            lambda r: F.struct(F.concat(acc["kept"], F.array(r["kept"])).alias("kept"), r["window"].alias("window")),
        )

    def fold(lines: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(lines), F.lit(LINES_PER_CHUNK))
        chunks = F.transform(starts, lambda i: F.slice(lines, i, LINES_PER_CHUNK))
        begin = F.struct(
            F.array().cast("array<array<string>>").alias("kept"),
            F.array().cast("array<array<string>>").alias("window"),
        )
        return F.aggregate(chunks, begin, fold_chunk, lambda acc: F.flatten(acc["kept"]))

    return F.array_join(bind(entries, fold), "\n")


def content_blocks(c: Column) -> Column:
    """X11: paragraphs of more than 20 characters, stripped, as an array."""
    blocks = F.transform(F.split(c, rf"\n{SPACE}*\n"), strip)
    return F.filter(blocks, lambda b: F.length(b) > MIN_BLOCK_CHARS)


def clean_text(c: Column, aggressive: bool = False, extra_patterns: list[str] | None = None) -> Column:
    """The whole cleaning chain.

    Aggressive mode drops blank lines before it looks for paragraphs, so it sees
    a single block and keeps it only if it is longer than 20 characters.
    """
    c = nfkd(c)
    if not aggressive:
        return clean_lines(c, extra_patterns=extra_patterns)
    c = clean_lines(
        c,
        min_line_length=MIN_LINE_AGGRESSIVE,
        preserve_structure=False,
        extra_patterns=extra_patterns,
    )
    return F.array_join(content_blocks(drop_repeated_lines(c)), "\n\n")
