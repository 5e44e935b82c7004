"""Text work over whole documents: X1-X17, P17, P18, A12, J13."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import functions as F

from certflow.functions import text as X
from certflow.functions.answers import (
    PLACEHOLDER, SECTIONS, fallback_sections, fill_and_cut, finished, parse_answer, section, strip_markdown,
)
from certflow.operators.prompts import extract_facts, render_prompt
from certflow.operators.reports import compression
from certflow.operators.worklists import not_done
from certflow.operators.spread import spread
from certflow.plans.jobs import cleaned_rows
from certflow.plans.queries.registry import query, table

# Documents with artefact lines around and between them; both engines read this alike.
DIRTY_TEXT = """concat('Page ', cast(doc_id AS string), chr(10), '  12 / 7  ', chr(10), text, chr(10), '---', chr(10),
  'http://a.b rest', chr(10), 'see http://a.b', chr(10), chr(10), chr(10), chr(9), chr(10), chr(10),
  'hello  worldAgain.Next', chr(10), ' - ', chr(10), 'ab', chr(10), 'DRAFT', chr(10), '31-12-24', chr(10),
  'me@x.no tail', chr(10), '© 2024 x', chr(10), '•▪', chr(10), 'Ø ★ ok', chr(10), text, chr(10), lang, ' a.b.c')"""

# Documents whose last lines repeat, on top of the repeats they hold anyway.
REPEATED_TEXT = """concat(text, chr(10), 'the last line of ', source, ' ', lang, chr(10), chr(10), 'The LAST  line of ',
  source, ' ', lang, chr(10), lang)"""

# The SQL side of the cleaning rules, on lists of lines. RE2 knows the same classes.
_B = r"\p{Z}\t\x0b\x0c\r\x1c-\x1f\x{85}"
_S = rf"[\n{_B}]"
_W = r"\p{L}\p{N}_"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_S}+|{_S}+$', '', 'g')"


_DROPS = "|".join([
    rf"\p{{Nd}}+$", rf"Page{_S}+\p{{Nd}}+$", rf"\p{{Nd}}+{_S}*/{_S}*\p{{Nd}}+$", r"[-_=]{3,}$", r"[•·▪▫■□▲△▼▽◆◇○●★☆]+$",
    rf"(?:https?://|www\.)[^\n{_B}]", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    r"(?:confidential|proprietary|draft|internal)$", "©", r"\p{Nd}{1,2}[-/]\p{Nd}{1,2}[-/]\p{Nd}{2,4}$",
])


def _fix(x: str) -> str:
    for pattern, new in [
        (r"[ \t]{2,}", " "), ("([a-z])([A-Z])", r"\1 \2"), (f"([{_W}])([.!?])([{_W}])", r"\1\2 \3"),
        (rf"{_S}+[^{_W}\n{_B}]{_S}+", " "),
    ]:
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return x


def _nfkd_sql(x: str) -> str:
    """Decomposition of the Latin letters up to U+017F, which covers the given tables."""
    for code in range(0xA0, 0x180):
        new = unicodedata.normalize("NFKD", chr(code))
        if new != chr(code):
            x = f"replace({x}, chr({code}), {' || '.join(f'chr({ord(n)})' for n in new)})"
    return x


def _clean_sql(x: str, minimum: int = 3, keep_blank: bool = True) -> str:
    lines = rf"string_split(regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{9f}}]', '', 'g'), chr(10))"
    blank = f"{_strip('x')} = ''"
    kept = f"list_filter({lines}, lambda x: {blank} OR NOT regexp_matches({_strip('x')}, '^(?i:{_DROPS})'))"
    fixed = f"list_transform({kept}, lambda x: CASE WHEN {blank} THEN NULL ELSE {_fix('x')} END)"
    long = f"list_filter({fixed}, lambda x: {'x IS NULL OR ' if keep_blank else 'x IS NOT NULL AND '} length({_strip('x')}) >= {minimum})"
    joined = f"array_to_string(list_transform({long}, lambda x: coalesce(x, '')), chr(10))"
    joined = rf"regexp_replace({joined}, '\n{_S}*\n{_S}*\n', chr(10) || chr(10), 'g')"
    return _strip(rf"regexp_replace({joined}, '[{_B}]+(\n|$)', '\1', 'g')")


def _documents(spark, sf, *columns: str):
    """Documents, spread over the cores for text work."""
    return spread(table(spark, sf, "documents").select("doc_id", *(columns or ("text", "source", "lang"))), "doc_id")


@query(f"SELECT doc_id, length(c) AS chars, md5(c) AS clean_md5 FROM (SELECT doc_id, {_clean_sql('t')} AS c FROM (SELECT doc_id, {DIRTY_TEXT} AS t FROM documents))")
def clean_lines(spark, sf):
    """X2-X8 on documents with artefact lines."""
    rows = _documents(spark, sf).select("doc_id", X.clean_lines(F.expr(DIRTY_TEXT)).alias("c"))
    return rows.select("doc_id", F.length("c").cast("long").alias("chars"), F.md5("c").alias("clean_md5"))


def _result_sql(clean: str) -> str:
    return f"""
SELECT file_id, md5(c) AS clean_md5, CASE WHEN length({_strip('t')}) < 10 THEN 'raw_too_short'
    WHEN length(c) < 5 THEN 'cleaned_too_short' ELSE 'success' END AS outcome,
  length(t) AS original_count, length(c) AS character_count, round((length(t) - length(c)) * 100.0 / length(t), 4) AS reduction_pct
FROM ({clean})"""


def _results(rows):
    return cleaned_rows(rows).select(
        "file_id", F.md5("clean_text").alias("clean_md5"), "outcome", "original_count", "character_count", "reduction_pct"
    )


@query(_result_sql(f"SELECT doc_id AS file_id, text AS t, {_clean_sql(_nfkd_sql('text'))} AS c FROM documents"))
def clean_basic(spark, sf):
    """Basic cleaning of every document."""
    return _results(table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), F.col("text").alias("extracted_text")))


@query(_result_sql(
    f"SELECT doc_id AS file_id, CASE WHEN doc_id % 50 = 0 THEN '  short  ' WHEN doc_id % 50 = 1 THEN '12' || chr(10) || 'Page 9' || chr(10) || 'ab' ELSE text END AS t, "
    f"{_clean_sql(_nfkd_sql('t'))} AS c FROM documents"
))
def clean_outcomes(spark, sf):
    """P17 with texts that are too short before or after cleaning."""
    text = (
        F.when(F.col("doc_id") % 50 == 0, "  short  ").when(F.col("doc_id") % 50 == 1, "12\nPage 9\nab").otherwise(F.col("text"))
    )
    return _results(table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), text.alias("extracted_text")))


def _tokens_sql(x: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array(lower({x}), '{_S}+'), lambda w: w <> ''))"


def _dedupe_sql(x: str) -> str:
    """X9 as a fold: places of the kept lines and the token sets of the last ten of them."""
    lines = f"string_split({x}, chr(10))"
    entry = f"list_transform({lines}, lambda l, i: {{'kept': [i], 'win': [{_tokens_sql('l')}]}})"
    inter = "len(list_intersect(w, e.win[1]))"
    sizes = "least(len(w), len(e.win[1])) * 10 >= greatest(len(w), len(e.win[1])) * 9 AND len(w) > 0"
    similar = f"CASE WHEN {sizes} THEN {inter} / (len(w) + len(e.win[1]) - {inter}) > 0.9 ELSE false END"
    seen = f"len(e.win[1]) > 0 AND len(list_filter(acc.win, lambda w: {similar})) > 0"
    grown = "{'kept': list_concat(acc.kept, e.kept), 'win': list_concat(list_slice(acc.win, -9, -1), e.win)}"
    kept = f"list_reduce({entry}, lambda acc, e: CASE WHEN {seen} THEN acc ELSE {grown} END).kept"
    return f"array_to_string(list_select({lines}, {kept}), chr(10))"


@query(f"SELECT doc_id, length(c) AS chars, md5(c) AS lines_md5 FROM (SELECT doc_id, {_dedupe_sql('t')} AS c FROM (SELECT doc_id, {REPEATED_TEXT} AS t FROM documents))")
def dedupe_lines(spark, sf):
    """Near-duplicate lines of each document."""
    rows = _documents(spark, sf).select("doc_id", X.drop_repeated_lines(F.expr(REPEATED_TEXT)).alias("c"))
    return rows.select("doc_id", F.length("c").cast("long").alias("chars"), F.md5("c").alias("lines_md5"))


def _blocks_sql(x: str) -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array({x}, '\\n{_S}*\\n'), lambda b: {_strip('b')}), lambda b: length(b) > 20)"
    )


@query(f"""
WITH s AS (SELECT doc_id, {_dedupe_sql(_clean_sql(_nfkd_sql('t'), 10, False))} AS c FROM (SELECT doc_id, {REPEATED_TEXT} AS t FROM documents))
SELECT doc_id, length(c) AS chars, md5(c) AS clean_md5 FROM (SELECT doc_id, array_to_string({_blocks_sql('c')}, chr(10) || chr(10)) AS c FROM s)
""")
def clean_aggressive(spark, sf):
    """X12 in aggressive mode."""
    rows = _documents(spark, sf).select("doc_id", X.clean_text(F.expr(REPEATED_TEXT), aggressive=True).alias("c"))
    return rows.select("doc_id", F.length("c").cast("long").alias("chars"), F.md5("c").alias("clean_md5"))


@query(f"""
SELECT doc_id, n AS block, md5(b) AS block_md5, length(b) AS chars FROM (
  SELECT doc_id, unnest(l) AS b, generate_subscripts(l, 1) - 1 AS n FROM (
    SELECT doc_id, {_blocks_sql('t')} AS l FROM (SELECT doc_id, {DIRTY_TEXT} AS t FROM documents)))
""")
def content_blocks(spark, sf):
    """X11: one row per paragraph."""
    rows = _documents(spark, sf).select("doc_id", F.posexplode_outer(X.content_blocks(F.expr(DIRTY_TEXT))).alias("n", "b"))
    rows = rows.filter(F.col("b").isNotNull())
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("block"), F.md5("b").alias("block_md5"), F.length("b").cast("long").alias("chars")
    )


@query(f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
p AS (SELECT doc_id, i, {_tokens_sql('ls[i]')} AS a, {_tokens_sql('ls[i + 1]')} AS b
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls))) AS i FROM l))
SELECT doc_id, i AS line, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0
  ELSE len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) END, 4) AS similarity FROM p
""")
def line_similarity(spark, sf):
    """X10 of each line with the next; the pairs are made inside the row."""
    lines = F.transform(F.split("text", "\n"), X.line_tokens)
    rows = _documents(spark, sf).select("doc_id", lines.alias("ls"))
    pairs = F.arrays_zip(
        F.slice("ls", F.lit(1), F.size("ls") - 1).alias("a"), F.slice("ls", F.lit(2), F.size("ls") - 1).alias("b")
    )
    rows = rows.select("doc_id", F.posexplode_outer(pairs).alias("i", "p")).filter(F.col("p").isNotNull())
    return rows.select(
        "doc_id", (F.col("i") + 1).cast("long").alias("line"), F.round(X.jaccard(F.col("p")["a"], F.col("p")["b"]), 4).alias("similarity")
    )


@query(f"""
SELECT lang, count(*) AS texts, CAST(sum(b) AS BIGINT) AS chars_before, CAST(sum(a) AS BIGINT) AS chars_after,
  round(min((b - a) * 100.0 / b), 4) AS min_pct, round(avg((b - a) * 100.0 / b), 4) AS avg_pct, round(max((b - a) * 100.0 / b), 4) AS max_pct
FROM (SELECT lang, length(text) AS b, length({_clean_sql(_nfkd_sql('text'))}) AS a FROM documents) GROUP BY 1
""")
def text_compression(spark, sf):
    """A12 per language."""
    rows = _documents(spark, sf).select("lang", F.length("text").alias("b"), F.length(X.clean_text(F.col("text"))).alias("a"))
    return compression(rows, "lang", F.col("b"), F.col("a"))


@query(f"""
WITH c AS (SELECT source, length({_strip('text')}) AS raw, length(text) AS b, length({_clean_sql(_nfkd_sql('text'))}) AS a
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT source, count(*) AS processed, count(*) FILTER (raw >= 10 AND a >= 5) AS successful,
  CAST(sum(b) AS BIGINT) AS chars_before, CAST(sum(a) AS BIGINT) AS chars_after,
  round((sum(b) - sum(a)) * 100.0 / sum(b), 4) AS reduction_pct
FROM c GROUP BY 1
""")
def clean_report(spark, sf):
    """C4 in one plan, the flagship: uncleaned documents, cleaned, judged and summed per source."""
    docs = table(spark, sf, "documents").select("source", F.col("doc_id").alias("file_id"), F.col("text").alias("extracted_text"))
    done = table(spark, sf, "labels").select(F.col("doc_id").alias("file_id"))
    work = spread(not_done(docs, done, ["file_id"]), "file_id")
    clean = work.withColumn("clean_text", X.clean_text(F.col("extracted_text")))
    raw_ok = F.length(X.strip(F.col("extracted_text"))) >= X.MIN_RAW_CHARS
    ok = raw_ok & (F.length("clean_text") >= X.MIN_CLEAN_CHARS)
    sums = clean.select(
        "source", ok.alias("ok"), F.length("extracted_text").cast("long").alias("b"), F.length("clean_text").cast("long").alias("a")
    )
    return sums.groupBy("source").agg(
        F.count("*").alias("processed"), F.count_if("ok").alias("successful"),
        F.sum("b").alias("chars_before"), F.sum("a").alias("chars_after"),
    ).withColumn("reduction_pct", F.round((F.col("chars_before") - F.col("chars_after")) / F.col("chars_before") * 100, 4))


# Answers made of whole documents, in the labelled format, with mark-up.
ANSWER_TEXT = """CASE
  WHEN doc_id % 6 = 0 THEN concat('Positive ting: only ', text)
  WHEN doc_id % 6 = 1 THEN concat('## **eiendom:** ', source, chr(10), '**POSITIVE TING:** ', lang, chr(10), '**Kort vurdering:** ', text)
  ELSE concat('Eiendom: A **b** ', text, chr(10), chr(10), 'Positive ting: - x_y_ `z` ', lang, chr(10), 'Kort vurdering: 1. ok # no ', source) END"""


def _markdown_sql(x: str) -> str:
    for pattern in [r"\*\*(.*?)\*\*", "__(.*?)__", r"\*(.*?)\*", "_(.*?)_", "`(.*?)`"]:
        x = rf"regexp_replace({x}, '{pattern}', '\1', 'g')"
    for pattern in [f"#{{1,6}}{_S}*", f"[-*+]{_S}*", rf"\p{{Nd}}+\.{_S}*"]:
        x = f"regexp_replace({x}, '(?m)^{pattern}', '', 'g')"
    return _strip(f"regexp_replace({x}, '{_S}+', ' ', 'g')")


def _section_sql(x: str, name: str) -> str:
    pattern = {
        "AboutEstate": rf"(?is)Eiendom:{_S}*(.*?)(?:Positive ting:|\z)",
        "Positives": rf"(?is)Positive ting:{_S}*(.*?)(?:Kort vurdering:|\z)",
        "Evaluation": rf"(?is)Kort vurdering:{_S}*(.*?)\z",
    }[name]
    raw = _strip(f"regexp_extract({_strip(x)}, '{pattern}', 1)")
    return _markdown_sql(rf"regexp_replace({raw}, '\n+', ' ', 'g')")


def _cut_sql(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN '{PLACEHOLDER}' WHEN length({x}) > 1990 THEN left({x}, 1987) || '...' ELSE {x} END"


@query(
    "WITH s AS (SELECT doc_id, " + ", ".join(f"{_section_sql('r', s)} AS {s}" for s in SECTIONS)
    + f" FROM (SELECT doc_id, {ANSWER_TEXT} AS r FROM documents)) SELECT doc_id, "
    + ", ".join(f"{_cut_sql(s)} AS {s}" for s in SECTIONS) + " FROM s"
)
def answer_sections(spark, sf):
    """X13, X15-X17."""
    rows = _documents(spark, sf).select("doc_id", F.expr(ANSWER_TEXT).alias("r"))
    rows = rows.select("doc_id", *[section(F.col("r"), s).alias(s) for s in SECTIONS])
    return rows.select("doc_id", *[fill_and_cut(F.col(s)).alias(s) for s in SECTIONS])


# Answers without the fixed labels: other header words, repeated headers, or none.
LOOSE_TEXT = """CASE
  WHEN doc_id % 4 = 0 THEN text
  WHEN doc_id % 4 = 1 THEN concat('Om eiendommen: ', source, chr(10), text, chr(10), chr(10), 'Positive forhold', chr(10), lang, chr(10), 'Konklusjon: ', text)
  WHEN doc_id % 4 = 2 THEN concat('start', chr(10), 'Vurdering: one', chr(10), text, chr(10), 'Konklusjon: two: ', lang, chr(10), ' more ')
  ELSE concat('Om eiendommen:', chr(10), 'Mange positive ting: ', text, chr(10), 'Om eiendommen', chr(10), '- _last_ ', source) END"""


def _fallback_sql(text: str) -> str:
    """X14 with windows: `d` holds the sections of each document, read line by line."""
    rest = _strip("substr(line, strpos(line, ':') + 1)")
    picked = ", ".join(f"coalesce(max(CASE sec WHEN '{s}' THEN {_markdown_sql('content')} END), '') AS {s}" for s in SECTIONS)
    return f"""
WITH l AS (SELECT doc_id, i, {_strip('ls[i]')} AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
    FROM (SELECT doc_id, string_split({text}, chr(10)) AS ls FROM documents))),
h AS (SELECT *, CASE WHEN contains(lower(line), 'eiendom:') OR contains(lower(line), 'om eiendommen') THEN 'AboutEstate'
    WHEN contains(lower(line), 'positive') AND (contains(lower(line), 'ting') OR contains(lower(line), 'forhold')) THEN 'Positives'
    WHEN contains(lower(line), 'vurdering') OR contains(lower(line), 'konklusjon') THEN 'Evaluation' END AS head
  FROM l WHERE line <> ''),
g AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM h),
c AS (SELECT doc_id, grp, coalesce(max(head), 'AboutEstate') AS sec, string_agg(CASE WHEN head IS NULL THEN line
    WHEN contains(line, ':') THEN nullif({rest}, '') END, ' ' ORDER BY i) AS content FROM g GROUP BY 1, 2),
s AS (SELECT doc_id, sec, arg_max(content, grp) AS content FROM c WHERE content IS NOT NULL GROUP BY 1, 2),
d AS (SELECT doc_id, {picked} FROM documents LEFT JOIN s USING (doc_id) GROUP BY 1)
"""


@query(_fallback_sql(LOOSE_TEXT) + f"SELECT doc_id, {', '.join(f'{_cut_sql(s)} AS {s}' for s in SECTIONS)} FROM d")
def answer_fallback(spark, sf):
    """X14, X16, X17."""
    rows = _documents(spark, sf).select("doc_id", finished(fallback_sections(X.strip(F.expr(LOOSE_TEXT)))).alias("p"))
    return rows.select("doc_id", "p.*")


MIXED_TEXT = f"CASE WHEN doc_id % 8 < 4 THEN {ANSWER_TEXT} ELSE {LOOSE_TEXT} END"


@query(
    _fallback_sql(MIXED_TEXT)
    + f", t AS (SELECT doc_id, {', '.join(f'{_section_sql(MIXED_TEXT, s)} AS {s}' for s in SECTIONS)} FROM documents),\n"
    + "m AS (SELECT doc_id, " + ", ".join(
        f"CASE WHEN t.AboutEstate = '' AND t.Positives = '' AND t.Evaluation = '' THEN d.{s} ELSE t.{s} END AS {s}" for s in SECTIONS)
    + f" FROM t JOIN d USING (doc_id)) SELECT doc_id, {', '.join(f'{_cut_sql(s)} AS {s}' for s in SECTIONS)} FROM m"
)
def answers_parsed(spark, sf):
    """X13-X17 as the job runs them, on a mix of both kinds of answers."""
    rows = _documents(spark, sf).select("doc_id", parse_answer(F.expr(MIXED_TEXT)).alias("p"))
    return rows.select("doc_id", "p.*")


MARKED = """concat('# ', role, chr(10), '- **', text, '** and __b__ *c* _d_ `e`', chr(10), '12. ', text, chr(10), '* x')"""


@query(f"SELECT conv_id, turn, {_markdown_sql('m')} AS plain FROM (SELECT conv_id, turn, {MARKED} AS m FROM conversations)")
def markdown_strip(spark, sf):
    """X15."""
    rows = spread(table(spark, sf, "conversations"), "conv_id").select("conv_id", "turn", F.expr(MARKED).alias("m"))
    return rows.select("conv_id", "turn", strip_markdown(F.col("m")).alias("plain"))


FACTS = {
    "energikarakter": "substr('ABCDEFGHIJ', CAST(o_orderkey % 8 AS INT) + 1, 1)",
    "oppvarmingskarakter": "CASE WHEN o_orderstatus = 'F' THEN 'Green' WHEN o_orderstatus = 'O' THEN 'Gul' END",
    "merkenummer": "concat('Energiattest-', cast(year(o_orderdate) AS string), '-', cast(o_orderkey AS string))",
    "utstedelsesdato": "cast(year(o_orderdate) AS string)",
    "byggear": "cast(1900 + c_custkey % 120 AS string)",
    "bygningskategori": "c_mktsegment",
    "enheter": "cast(c_custkey % 5 + 1 AS string)",
    "innmelder": "upper(c_mktsegment)",
    "adresse": "c_name",
    "bruksareal": "cast(c_custkey AS string)",
    "kwh_m2": "cast(o_totalprice AS string)",
    "kwh": "cast(o_custkey * 7 AS string)",
    "fossilandel": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '27' END",
}


# The whole prompt once more, on its own, so that an error in the parts above shows.
PROMPT = (
    "Opptre som ekspert i et selskap som lever av å selge informasjon om eiendom og bygninger. Du skal oppsummere relevante "
    "forhold knyttet til energimerke fra Enova med Energikarakter {energikarakter} og Oppvarmingskarakter {oppvarmingskarakter} for "
    "boligen. Merkenummer er '{merkenummer}' datert {utstedelsesdato}. Hold deg til fakta og ikke gå ut over 500 ord. Byggeår er "
    "{byggear} og bygningskategori er {bygningskategori}. Attesten dekker {enheter} registrerte enheter. Energiattesten er innmeldt "
    "av {innmelder}. Innmeldt adresse {adresse}. Bruksareal {bruksareal} kvadratmeter. Beregnet Levert Energi Totalt kWh/m2: "
    "{kwh_m2}. Beregnet Levert Energi Totalt kWh: {kwh}. Beregnet Fossilandel er {fossilandel}%. {text}\n\nSvaret skal være på dette "
    "formatet: \nEiendom: Litt om eiendommen \nPositive ting: Hva er bra i forhold til Energiattesten \nKort vurdering: Spesielle "
    "forhold som bør trekkes frem av en eller annen art."
)


def _prompt_sql() -> str:
    values = {**FACTS, "text": "o_orderpriority"}
    pieces = re.split(r"\{(\w+)\}", PROMPT)
    return " || ".join(
        f"coalesce({values[p]}, 'ukjent')" if k % 2 else "'" + p.replace("'", "''") + "'" for k, p in enumerate(pieces))


PROMPT_SQL = f"SELECT o_orderkey, {_prompt_sql()} AS prompt FROM orders JOIN customer ON o_custkey = c_custkey"


def _order_prompts(spark, sf):
    orders = spread(table(spark, sf, "orders"), "o_orderkey")
    rows = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    prompt = render_prompt({k: F.expr(v) for k, v in FACTS.items()}, F.col("o_orderpriority"))
    return rows.select("o_orderkey", prompt.alias("prompt"))


@query(PROMPT_SQL)
def prompt_assembly(spark, sf):
    """P18."""
    return _order_prompts(spark, sf)


@query(f"""
SELECT o_orderkey, upper(nullif(regexp_extract(prompt, '(?i)energikarakter\\s+([A-G])(?:[^\\p{{L}}\\p{{N}}]|$)', 1), '')) AS rating,
  nullif(regexp_extract(prompt, '(?i)oppvarmingskarakter\\s+(\\p{{L}}+)', 1), '') AS heating,
  nullif(regexp_extract(prompt, '(?i)(energiattest-[0-9]{{4}}-[0-9]+)', 1), '') AS certificate,
  CAST(nullif(regexp_extract(prompt, '(?i)byggeår\\s+(?:er\\s+)?([0-9]{{4}})', 1), '') AS INTEGER) AS built,
  CAST(nullif(regexp_extract(prompt, '(?i)kWh/m2:?\\s*([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS kwh_m2
FROM ({PROMPT_SQL})
""")
def fact_extract(spark, sf):
    """The facts read back from the prompts."""
    return _order_prompts(spark, sf).select("o_orderkey", *extract_facts(F.col("prompt")))
