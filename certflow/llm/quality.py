"""Line-first quality rules: judge and remove lines, then reject documents that lose too much."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certflow.llm.tasks import steps

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SEPARATOR_PERCENT = 10
BOILERPLATE_PERCENT = 10

# Fixed rules on a line without white space at its ends. The SQL twin uses these patterns and the same shares of words.
LINE_END = r"[.!?…:;\"'”’»)\]。！？]$"
SENTENCE = r"[.!?…] "
PUNCTUATION = r"[!-/:-@\[-`{-~]"
BOILERPLATE = (
    r"cookie|javascript|lorem ipsum|privacy policy|terms of (use|service)|all rights reserved"
    r"|subscribe|click here|sign in|log in|read more|powered by"
    r"|tous droits réservés|mentions légales|politique de confidentialité|cliquez ici|lire la suite"
    r"|alle rechte vorbehalten|impressum|datenschutzerklärung|hier klicken|weiterlesen"
    r"|todos los derechos reservados|aviso legal|política de privacidad|haga clic aquí|leer más"
)
# » › and > are also closing marks: they part a menu only between spaces and with no opening mark before them.
SEPARATOR = r"[|•]|(?<= )[»›>](?= )"
PHRASE = rf"\b(?:un)?(?:{BOILERPLATE})s?\b"
_line_end, _sentence, _punctuation, _separator, _phrase = map(
    re.compile, (LINE_END, SENTENCE, PUNCTUATION, SEPARATOR, PHRASE))
_lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
RESULT = f"{MEASURES}, n_lines long, n_failed_lines long, lost_chars long, kept boolean, clean_text string"


def separators(line: str) -> int:
    """Marks that part the entries of a menu; marks that close a quotation or a tag are none."""
    found = list(_separator.finditer(line))
    if not found:
        return 0
    first = lambda marks: min((k for k in map(line.find, marks) if k >= 0), default=len(line))
    before = {"»": first("«‹"), "›": first("«‹"), ">": first("<")}
    return sum(m.start() < before.get(m[0], len(line)) for m in found)


def line_failure(line: str, n_words: int, max_marks: int, max_separators: int) -> str | None:
    """The rule that a line with words fails: punctuation, navigation, boilerplate or none."""
    line = line.strip(SPACE)
    closed = _line_end.search(line) or _sentence.search(line)
    if not closed or len(_punctuation.findall(line)) > max(max_marks, n_words):
        return "punctuation"
    if separators(line) > max(max_separators, n_words * SEPARATOR_PERCENT // 100):
        return "navigation"
    phrase_words = sum(m[0].count(" ") + 1 for m in _phrase.finditer(line.translate(_lower)))
    if phrase_words and 100 * phrase_words >= BOILERPLATE_PERCENT * n_words:
        return "boilerplate"
    return None


def repeated_words(words: list) -> int:
    """Words inside windows of five words that occur twice or more; each word counts once. Exact: no hashes."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    size = len(seen)
    if size < 6000:  # size ** 5 fits into 63 bits
        code = ids[:n].copy()
        for k in range(1, WINDOW):
            code = code * size + ids[k:n + k]
    else:
        pair = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        four = np.unique(pair[:-2] * (len(words) + 1) + pair[2:], return_inverse=True)[1]
        code = four[:n] * size + ids[WINDOW - 1:]
    _, which, count = np.unique(code, return_inverse=True, return_counts=True)
    starts = (count[which] > 1).astype(np.int64)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += starts
    edge[WINDOW:n + WINDOW] -= starts
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def measure(text: str | None, max_loss: int, max_marks: int, max_separators: int) -> tuple:
    """One row of RESULT for a text."""
    text = text or ""
    words = words_of(text)
    word_chars = len(text) - sum(map(text.count, SPACE))
    kept_lines, seen, lines, failed, repeats, lost = [], set(), 0, 0, 0, 0
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "surrogatepass").split())
        if not n:
            kept_lines.append(line)
            continue
        lines += 1
        repeats += line in seen
        seen.add(line)
        if line_failure(line, n, max_marks, max_separators):
            failed += 1
            lost += len(line) - sum(map(line.count, SPACE))
        else:
            kept_lines.append(line)
    n_repeat = repeated_words(words)
    base_failed = len(words) < 10 or 100 * n_repeat > 20 * len(words)
    kept = not base_failed and 100 * lost <= max_loss * word_chars
    return (len(words), word_chars, sum(map(text.count, SYMBOLS)), repeats, n_repeat, base_failed, lines, failed, lost,
            kept, text if not failed else "\n".join(kept_lines))


def judge_quality(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, max_loss: int = 40, max_marks: int = 3,
    max_separators: int = 1,
) -> DataFrame:
    """Measures and verdict per row: doc_id and the columns of RESULT.

    A line with words fails if it neither ends in a punctuation mark that closes a sentence or
    quotation nor holds the end of a sentence, or if it holds more ASCII punctuation than words
    (and than max_marks); if it holds more
    than max_separators menu separators, and more than one for ten words; or if boilerplate
    phrases (whole words) make up a tenth of its words or more. Marks that close a quotation are no separators. Failed lines are left out of clean_text.
    A document is kept unless base_failed (fewer than 10 words, or over
    20 % of them in repeated five-word windows) or unless its failed lines hold over
    max_loss % of the code points of its words.

    Null and empty texts have no words and fail. Lines without words are kept as they are.
    Repeated rows give a row each; extra columns are ignored; doc_id may be null.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = [measure(x, max_loss, max_marks, max_separators) for x in batch.column("text").to_pylist()]
            yield _with([batch.column("doc_id")], ["doc_id"], rows)

    return source.mapInArrow(judge, f"doc_id {kind}, {RESULT}")


def _with(columns: list, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [x.split() for x in RESULT.split(", ")]
    made = [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays([*columns, *made], names=[*names, *(n for n, _ in fields)])


def clean_documents(
    docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", *, max_loss: int = 40, max_marks: int = 3,
    max_separators: int = 1,
) -> DataFrame:
    """The kept rows with all their columns; failed lines are gone from `text`, and `n_chars` counts anew.

    Rules and edge cases as for judge_quality. Narrow: rows never leave their task.
    """
    at = docs.columns.index(text)
    count_at = docs.columns.index(n_chars) if n_chars in docs.columns else None
    whole = docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = [measure(x, max_loss, max_marks, max_separators) for x in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([r[-1] for r in rows], columns[at].type)
            if count_at is not None:
                columns[count_at] = pa.array([len(r[-1]) for r in rows]).cast(columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array([r[-2] for r in rows]))

    return docs.mapInArrow(clean, whole)
