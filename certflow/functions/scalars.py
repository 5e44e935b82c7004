"""Scalar rules on codes, names and URLs: X18-X20, P8, P10-P12, P19, F1."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from certflow.functions.binding import bind

# Score per rating letter, anything else is 0.
ENERGY_SCORES = {"A": 100, "B": 85, "C": 70, "D": 55, "E": 40, "F": 25, "G": 10}
# Characters not allowed in file names, and the query keys that may hold one.
ILLEGAL_IN_NAMES = '<>:"/\\|?*'
NAME_KEYS = ["filename", "file", "name", "rscd"]
FALLBACK_NAME_PREFIX = "energiattest_"
# Names of landed yearly files.
LANDED_URL_PREFIX = "enova_"
LANDED_DATED_PREFIX = "enova_certificates_"
# Keys of a request payload.
PAYLOAD_KEYS = [
    "kommunenummer", "gardsnummer", "bruksnummer",
    "seksjonsnummer", "bruksenhetnummer", "bygningsnummer",
]
MB = 1024 * 1024


def energy_score(rating: Column) -> Column:
    """0-100 score; only the first ten characters count, blanks and case do not."""
    code = F.upper(F.trim(F.left(rating, F.lit(10))))
    rule = None
    for letter, score in ENERGY_SCORES.items():
        rule = F.when(code == letter, score) if rule is None else rule.when(code == letter, score)
    return rule.otherwise(0)


def register_sql_functions(spark: SparkSession) -> None:
    """the same rule as a SQL function, inlined by the analyzer."""
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in ENERGY_SCORES.items())
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION calculate_energy_score(rating STRING) RETURNS INT "
        f"RETURN CASE upper(trim(left(rating, 10))) {cases} ELSE 0 END"
    )


def not_blank(c: Column) -> Column:
    """Not null and not only spaces (spaces only, as in T-SQL)."""
    return c.isNotNull() & (F.length(F.trim(c)) > 0)


def preview(c: Column, n: int = 200) -> Column:
    """The first n characters and dots."""
    return F.concat(F.left(c, F.lit(n)), F.lit("..."))


def whole_mb(size: Column) -> Column:
    """Bytes to whole MB, cut as integer division does."""
    return F.floor(size / MB)


def request_payload(columns: dict[str, Column]) -> Column:
    """JSON text of the six keys; null, '' and ' ' are left out, values become text."""
    kept = []
    for key in PAYLOAD_KEYS:
        text = columns[key].cast("string")
        kept.append(F.when(~text.isin("", " "), text).alias(key))
    return F.to_json(F.struct(*kept))


def certificate_number(url: Column) -> Column:
    """P10: last path part up to the first `.pdf`, null for an empty URL."""
    return F.when(url != "", F.split_part(F.element_at(F.split(url, "/"), -1), F.lit(".pdf"), F.lit(1)))


def file_name_from_url(url: Column) -> Column:
    """File name of a download URL.

    The parts are taken by pattern and not by a URI parser, so that odd URLs
    still give a name. Without any name the SHA-256 of the URL stands in for it.
    """
    uri = r"(?s)\A(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)(?:\?([^#]*))?"

    def parameter(query: Column, key: str) -> Column:
        raw = F.regexp_extract(query, f"(?:^|&){key}=([^&]+)", 1)
        value = bind(raw, lambda r: F.coalesce(F.try_url_decode(r), r))
        return bind(value, lambda v: F.when(F.lower(v).contains(".pdf"), v))

    def choose(path: Column, value: Column) -> Column:
        inner = F.split_part(F.split_part(value, F.lit("filename="), F.lit(2)), F.lit(";"), F.lit(1))
        return (
            F.when(path.endswith(".pdf"), path)
            .when(value.contains("filename="), F.btrim(inner, F.lit('"')))
            .when(value.endswith(".pdf"), value)
            .otherwise(path)
        )

    def name_of(p: Column) -> Column:
        # the first key that holds a PDF name counts, also when that name is unusable
        value = F.coalesce(*[parameter(p["query"], k) for k in NAME_KEYS])
        return bind(value, lambda v: choose(p["path"], v))

    last = F.regexp_extract(F.regexp_extract(url, uri, 1), r"([^/;]*)(?:;[^/]*)?\z", 1)
    name = bind(F.struct(last.alias("path"), F.regexp_extract(url, uri, 2).alias("query")), name_of)
    hashed = F.concat(F.lit(FALLBACK_NAME_PREFIX), F.sha2(url, 256), F.lit(".pdf"))
    final = bind(name, lambda n: F.when(n.endswith(".pdf"), n).otherwise(hashed))
    return F.translate(final, ILLEGAL_IN_NAMES, "_" * len(ILLEGAL_IN_NAMES))


def landed_name(year: Column, url: Column, from_date: Column, to_date: Column, stamp: Column) -> Column:
    """Name of a landed yearly file: from its URL, else its ISO dates, else a time stamp."""
    path = F.regexp_extract(url, r"(?s)\A(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    last = F.element_at(F.split(path, "/"), -1)

    def day(c: Column) -> Column:
        return F.date_format(F.try_to_timestamp(F.left(c, F.lit(10)), F.lit("yyyy-MM-dd")), "yyyyMMdd")

    head = F.concat(F.lit(LANDED_DATED_PREFIX), year, F.lit("_"))
    dated = F.concat(head, day(from_date), F.lit("_"), day(to_date), F.lit(".csv"))
    stamped = F.concat(head, F.date_format(stamp, "yyyyMMdd_HHmmss"), F.lit(".csv"))
    named = F.concat(F.lit(LANDED_URL_PREFIX), year, F.lit("_"), last)
    return F.when(last.contains("."), named).otherwise(F.coalesce(dated, stamped))


def error_text(c: Column, n: int = 200) -> Column:
    """Error text cut for the log."""
    return F.left(c, F.lit(n))
