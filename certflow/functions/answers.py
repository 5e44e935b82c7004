"""Parsing of generated answers: X13-X17."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from certflow.functions.binding import bind
from certflow.functions.text import DIGIT, SPACE, strip

# Fixed values of the answer format.
SECTIONS = ["AboutEstate", "Positives", "Evaluation"]
PLACEHOLDER = "Ikke tilgjengelig i responsen"
MAX_SECTION = 1990
CUT_SECTION = 1987
_SECTION_PATTERNS = {
    "AboutEstate": rf"(?isu)Eiendom:{SPACE}*(.*?)(?=Positive ting:|\z)",
    "Positives": rf"(?isu)Positive ting:{SPACE}*(.*?)(?=Kort vurdering:|\z)",
    "Evaluation": rf"(?isu)Kort vurdering:{SPACE}*(.*)\z",
}
# Mark-up pairs whose content is kept, and line starts to drop.
_PAIRED = [r"\*\*(.*?)\*\*", r"__(.*?)__", r"\*(.*?)\*", r"_(.*?)_", r"`(.*?)`"]
_LINE_STARTS = [rf"#{{1,6}}{SPACE}*", rf"[-*+]{SPACE}*", rf"{DIGIT}+\.{SPACE}*"]


def strip_markdown(c: Column) -> Column:
    """Bold, italic, code, headers, bullets, numbers, then white space."""
    for pattern in _PAIRED:
        c = F.regexp_replace(c, f"(?d){pattern}", "$1")
    for pattern in _LINE_STARTS:
        c = F.regexp_replace(c, f"(?md)^{pattern}", "")
    return strip(F.regexp_replace(c, f"{SPACE}+", " "))


def section(c: Column, name: str) -> Column:
    """One labelled section of an answer, without mark-up, '' when absent."""
    raw = strip(F.regexp_extract(strip(c), _SECTION_PATTERNS[name], 1))
    return strip_markdown(F.regexp_replace(raw, r"\n+", " "))


def fallback_sections(c: Column) -> Column:
    """Struct of the three sections read line by line.

    Header words open a section, a repeated header overwrites it, and leading
    text without a header counts as the first section.
    """
    lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")

    def header(line: Column) -> Column:
        low = F.lower(line)
        return (
            F.when(low.contains("eiendom:") | low.contains("om eiendommen"), F.lit("AboutEstate"))
            .when(
                low.contains("positive") & (low.contains("ting") | low.contains("forhold")),
                F.lit("Positives"),
            )
            .when(low.contains("vurdering") | low.contains("konklusjon"), F.lit("Evaluation"))
            .otherwise(F.lit(""))
        )

    entries = F.transform(
        lines,
        lambda x: F.struct(
            x.alias("line"),
            header(x).alias("header"),
            # text after the first colon, '' without one
            strip(F.regexp_extract(x, r"(?s)\A[^:]*:(.*)\z", 1)).alias("rest"),
        ),
    )

    def blocks(e: Column) -> Column:
        """Header and lines of each block in order; every line lies in one block, so the work is linear."""
        n = F.size(e)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        heads = F.filter(places, lambda i: e[i]["header"] != "")

        def between(start: Column, stop: Column) -> Column:
            return F.transform(F.slice(e, start + 1, stop - start), lambda x: x["line"])

        def block(i: Column, stop: Column) -> Column:
            rest = F.filter(F.array(e[i]["rest"]), lambda x: x != "")
            return F.struct(e[i]["header"].alias("header"), F.concat(rest, between(i + 1, stop)).alias("lines"))

        def with_bounds(bounds: Column) -> Column:
            opened = F.transform(F.slice(bounds, 1, F.size(bounds) - 1), lambda i, k: block(i, bounds[k + 1]))
            first = F.struct(F.lit("AboutEstate").alias("header"), between(F.lit(0), bounds[0]).alias("lines"))
            return F.filter(F.concat(F.array(first), opened), lambda b: F.size(b["lines"]) > 0)

        return bind(F.concat(heads, F.array(n)), with_bounds)

    def last(found: Column, name: str) -> Column:
        same = F.filter(found, lambda b: b["header"] == name)
        text = F.array_join(F.try_element_at(same, F.lit(-1))["lines"], " ")
        return strip_markdown(F.coalesce(text, F.lit("")))

    return bind(bind(entries, blocks), lambda f: F.struct(*[last(f, s).alias(s) for s in SECTIONS]))


def fill_and_cut(c: Column) -> Column:
    """Placeholder for an empty section, long ones cut with dots."""
    return (
        F.when(c == "", F.lit(PLACEHOLDER))
        .when(F.length(c) > MAX_SECTION, F.concat(F.left(c, F.lit(CUT_SECTION)), F.lit("...")))
        .otherwise(c)
    )


def parse_answer(c: Column) -> Column:
    """Struct of the three final sections; the line reading runs only where all are empty."""
    labelled = F.struct(*[section(c, s).alias(s) for s in SECTIONS])

    def choose(found: Column) -> Column:
        none = (found["AboutEstate"] == "") & (found["Positives"] == "") & (found["Evaluation"] == "")
        return F.when(none, fallback_sections(strip(c))).otherwise(found)

    return finished(bind(labelled, choose))


def finished(sections: Column) -> Column:
    """X16, X17 on a struct of sections."""
    return bind(sections, lambda p: F.struct(*[fill_and_cut(p[s]).alias(s) for s in SECTIONS]))
