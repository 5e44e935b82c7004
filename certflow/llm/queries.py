"""One query per operator over the given tables, with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certflow.llm import bpe, embeddings, language_id, lm_scoring, mixing, preference, url_filter, warc_zip
from certflow.llm.collocations import collocations
from certflow.llm.fingerprints import edited_likeness
from certflow.llm.near_dedup import near_duplicates
from certflow.llm.quality import BOILERPLATE, BOILERPLATE_PERCENT, LINE_END, PUNCTUATION, SENTENCE, SEPARATOR_PERCENT, judge_quality
from certflow.llm.whitening import whiten
from certflow.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2)


SQL["op1_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         E' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w = [''] THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), classes AS (
  SELECT min(doc_id) AS id, list_sort(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), items AS (SELECT id, n, unnest(s) AS x FROM classes
), often AS (SELECT x, count(*) AS df FROM items GROUP BY x
), ranked AS (
  SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY df, x) AS r FROM items JOIN often USING (x)
), prefix AS (SELECT id, n, x FROM ranked WHERE r <= n - CAST(ceil(0.8 * n - 1e-9) AS BIGINT) + 1
), candidates AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b ON a.x = b.x AND a.id < b.id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), common AS (
  SELECT a, b, count(*) AS c FROM candidates JOIN items i ON i.id = a JOIN items j ON j.id = b AND i.x = j.x GROUP BY a, b
), links AS (
  SELECT a, b FROM common JOIN classes i ON i.id = a JOIN classes j ON j.id = b WHERE 100 * c >= 80 * (i.n + j.n - c)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (SELECT id AS a, id AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id,
  coalesce(k.component_id, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN component k ON k.id = c.id
"""


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _node(url: str) -> str:
    bare = f"regexp_extract({url}, '(?s)^([^#]*)', 1)"
    head = f"regexp_extract({bare}, '(?s)^(.*?://[^/?#]*)', 1)"
    return f"CASE WHEN {head} <> '' THEN translate({head}, {_UPPER}, {_LOWER}) || substr({bare}, len({head}) + 1) END"


def _rule(host: str, path: str, what: int) -> str:
    values = (("'net/'", "'block'"), ("'org/fr/'", "'allow'"), ("'example.com/de/'", "'block'"), ("'example.net/en/'", "'allow'"))
    found = "NULL"
    for rule, verdict in values:
        name, prefix = rule.strip("'").split("/", 1)
        fits = f"({host} = '{name}' OR {host} LIKE '%.{name}') AND {path} LIKE '/{prefix}%'"
        found = f"CASE WHEN {fits} THEN {(rule, verdict)[what]} ELSE {found} END"
    return found


_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_HOST = f"translate(coalesce(regexp_extract({{0}}, '(?s)^.*?://([^/?#]*)', 1), ''), {_UPPER}, {_LOWER})"
_PATH = "coalesce(regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
SQL["op3_url_filter"] = rf"""
WITH RECURSIVE found AS (
  SELECT url, unnest(list_concat(
    list_transform(regexp_extract_all(bare, '(?i)<link\s[^>]*rel\s*=\s*["'']?canonical["''\s>/][^>]*>?'),
      lambda t: regexp_extract(t, '(?i)\shref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(regexp_extract_all(bare, '(?i)<meta\s[^>]*http-equiv\s*=\s*["'']?refresh["''\s>/][^>]*>?'),
      lambda t: regexp_extract(t, '(?i)url\s*=\s*["'']?([^"''\s>]+)', 1)))) AS raw
  FROM (SELECT url, regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)', ' ', 'g') AS bare
        FROM pages WHERE contains(url, '://'))
), targets AS (
  SELECT url, replace(raw, '&amp;', '&') AS t, regexp_extract(url, '(?s)^.*?://[^/?#]*(/(?:[^?#]*/)?)', 1) AS folder,
    regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS root FROM found WHERE raw <> ''
), full_targets AS (
  SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN t LIKE '//%' THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || t WHEN t LIKE '/%' THEN root || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE root || CASE WHEN folder = '' THEN '/' ELSE folder END || t END AS target FROM targets
), edges AS (SELECT {_node("url")} AS a, {_node("target")} AS b FROM full_targets WHERE target IS NOT NULL
), both_ways AS (SELECT a, b FROM edges WHERE b IS NOT NULL UNION SELECT b, a FROM edges WHERE b IS NOT NULL
), bad AS (
  SELECT a AS node FROM both_ways WHERE {_rule(_HOST.format("a"), _PATH.format("a"), 1)} = 'block'
  UNION SELECT e.b FROM bad JOIN both_ways e ON e.a = bad.node
), page AS (SELECT page_id, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, {_node("url")} AS node FROM pages
)
SELECT page_id, host, path, {_rule("host", "path", 0)} AS rule, node IN (SELECT node FROM bad) IS TRUE AS alias_blocked,
  coalesce({_rule("host", "path", 1)}, CASE WHEN (node IN (SELECT node FROM bad)) IS TRUE THEN 'block' ELSE 'allow' END) AS verdict
FROM page
"""


@query
def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc_zip.write_archives(warc_zip.planned(spark.read.parquet(f"{sf_dir}/pages.parquet")), folder)
    return warc_zip.read_records(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op4_warc_zip"] = """
WITH base AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), first AS (SELECT html, min(page_id) AS first_id FROM base GROUP BY html
), hashed AS (
  SELECT page_id, octet_length(encode(b.html)) AS n, sha1(b.html) AS h, first_id FROM base b JOIN first f ON b.html = f.html
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.withColumn("clean_sha256", F.sha2("clean_text", 256)).drop("clean_text")


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# Non-word characters and spaces are doubled first, so that neighbouring hits can each have one on either side.
_PHRASE = "(?:^|[^\\p{L}\\p{N}_])((?:un)?(?:" + BOILERPLATE.replace(" ", "  ") + ")s?)(?:$|[^\\p{L}\\p{N}_])"
_PHRASES = f"regexp_extract_all(regexp_replace(translate(bare, {_UPPER}, {_LOWER}), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g'), {_sql(_PHRASE)}, 1)"
_PARTED = "len(regexp_extract_all(replace(regexp_extract(bare, '^[^{0}]*'), ' ', '  '), ' [{1}] '))"
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
SQL["op5_quality"] = rf"""
WITH base AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS w FROM documents
), windows AS (
  SELECT k, i, w[i:i + 4] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM base)
), often AS (SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, g) > 1
), repeated AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS p FROM often) GROUP BY k
), lines AS (
  SELECT k, i, line, trim(line, E' \t\x0b\f\r') AS bare, {_WORDS.format("line")} AS lw
  FROM (SELECT k, unnest(t) AS line, generate_subscripts(t, 1) AS i FROM (SELECT k, string_split(text, E'\n') AS t FROM base))
), judged AS (
  SELECT k, line, i, len(array_to_string(lw, '')) AS chars,
    NOT (regexp_matches(bare, {_sql(LINE_END)}) OR regexp_matches(bare, {_sql(SENTENCE)}))
    OR len(regexp_extract_all(bare, {_sql(PUNCTUATION)})) > greatest(3, len(lw))
    OR len(regexp_extract_all(bare, '[|•]')) + {_PARTED.format("«‹", "»›")} + {_PARTED.format("<", ">")} > greatest(1, len(lw) * {SEPARATOR_PERCENT} // 100)
    OR (len(phrases) > 0 AND 100 * list_sum(list_transform(phrases, lambda p: (len(p) - len(replace(p, '  ', ''))) // 2 + 1)) >= {BOILERPLATE_PERCENT} * len(lw))
    AS failed
  FROM (SELECT *, {_PHRASES} AS phrases FROM lines) WHERE len(lw) > 0
), cleaned AS (
  SELECT k, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (NOT coalesce(failed, false)) AS clean_text
  FROM lines l LEFT JOIN (SELECT k, i, failed FROM judged) USING (k, i) GROUP BY k
), line_sums AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup, count(*) FILTER (failed) AS n_failed,
    coalesce(sum(chars) FILTER (failed), 0) AS lost FROM judged GROUP BY k
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, len(w) < 10 OR 100 * coalesce(r.n, 0) > 20 * len(w) AS base_failed,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_failed, 0) AS n_failed_lines, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars,
    sha256(coalesce(clean_text, '')) AS clean_sha256
  FROM base LEFT JOIN repeated r USING (k) LEFT JOIN line_sums USING (k) LEFT JOIN cleaned USING (k)
)
SELECT *, NOT base_failed AND 100 * lost_chars <= 40 * word_chars AS kept FROM measured
"""


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = bpe.tokenizer_file("word_bpe_49k.json")
    return bpe.digests(bpe.encode_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), file, decoded=True))


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


SQL["op7_lm_scoring"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id,
    {_WORDS.format("translate(coalesce(text, ''), " + _UPPER + ", " + _LOWER + ")")} AS w FROM documents
), tokens AS (
  SELECT k, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS u, len(w) AS n FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM docs)
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY w, k) AS c1,
    count(*) OVER (PARTITION BY u, w) - count(*) OVER (PARTITION BY u, w, k) AS c2, count(*) OVER () - n AS others FROM tokens
), with_context AS (SELECT *, lag(c1) OVER (PARTITION BY k ORDER BY i) AS context FROM counted
), scored AS (
  SELECT k, CASE WHEN c1 > 0 THEN ln(c1) - ln(others) ELSE -ln(others + 1) END AS s1, u, c2, context FROM with_context
), summed AS (
  SELECT k, sum(CASE WHEN u IS NULL THEN s1 WHEN c2 > 0 THEN ln(c2) - ln(context) ELSE ln(0.4) + s1 END) AS s FROM scored GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(s / len(w), 6) AS mean_log_score FROM docs LEFT JOIN summed USING (k)
"""


@query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL["op8_embeddings"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), fit AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM vectors
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(v, v) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    AND list_inner_product(a.v, b.v) >= 0.9 * a.norm * b.norm
), reach AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counts USING (vec_id)
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query
def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    made = preference.preference_pairs(
        turns.withColumnRenamed("conv_id", "pair_id"), preference.swapped_answers(turns).withColumnRenamed("conv_id", "pair_id"))
    return made.withColumns({c: F.to_json(c) for c in ("chosen_mask", "rejected_mask")})


_PLAIN = r"regexp_replace(coalesce({}, ''), '<\|(im_start|im_end)\|>', '<\1>', 'g')"
SQL["op10_preference"] = rf"""
WITH last AS (
  SELECT conv_id, max(turn) AS last_turn, max_by(text, (turn, text)) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), ends AS (SELECT a.conv_id, a.last_turn, b.answer FROM last a JOIN last b ON b.conv_id = xor(a.conv_id, 1)
), sides AS (
  SELECT conv_id AS p, true AS good, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT c.conv_id, false, turn, role, CASE WHEN role = 'assistant' AND turn = last_turn THEN answer ELSE text END
  FROM conversations c LEFT JOIN ends e ON c.conv_id = e.conv_id WHERE c.conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY p, good ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,
    '<|im_start|>' || {_PLAIN.format("role")} || chr(10) AS head, {_PLAIN.format("text")} || '<|im_end|>' || chr(10) AS tail FROM sides
), matched AS (
  SELECT coalesce(a.p, b.p) AS p, coalesce(a.i, b.i) AS i, a.i IS NOT NULL AND b.i IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role
    AND a.text IS NOT DISTINCT FROM b.text AS same
  FROM (SELECT * FROM placed WHERE good) a FULL JOIN (SELECT * FROM placed WHERE NOT good) b ON a.p = b.p AND a.i = b.i
), prefix AS (SELECT p, coalesce(min(i) FILTER (NOT same) - 1, count(*)) AS n FROM matched GROUP BY p
), rest AS (
  SELECT l.*, n, coalesce(sum(len(head) + len(tail)) OVER (PARTITION BY p, good ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM placed l JOIN prefix USING (p) WHERE i > n
), completions AS (
  SELECT p, good, string_agg(head || tail, '' ORDER BY i) AS text, bool_or(role = 'assistant') AS trained,
    string_agg('{{"begin":' || (pos + len(head))::BIGINT || ',"end":' || (pos + len(head) + len(tail) - 1)::BIGINT || '}}', ',' ORDER BY i)
      FILTER (role = 'assistant') AS mask FROM rest GROUP BY p, good
), prompts AS (
  SELECT p, any_value(n) AS n, coalesce(string_agg(head || tail, '' ORDER BY i) FILTER (i <= n AND good), '') AS prompt
  FROM placed JOIN prefix USING (p) GROUP BY p
)
SELECT x.p AS pair_id, CAST(x.n AS BIGINT) AS n_prompt_turns, prompt, coalesce(c.text, '') AS chosen, '[' || coalesce(c.mask, '') || ']' AS chosen_mask,
  coalesce(r.text, '') AS rejected, '[' || coalesce(r.mask, '') || ']' AS rejected_mask,
  coalesce(c.trained, false) AND coalesce(r.trained, false) AS is_pair
FROM prompts x LEFT JOIN completions c ON c.p = x.p AND c.good LEFT JOIN completions r ON r.p = x.p AND NOT r.good
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_PIECES = rf"string_split_regex(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[.,;:!?\x0A-\x0D]')"
SQL["op11_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents)
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, p, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)
), counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND f >= 100
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM candidates)) GROUP BY ALL
), whole AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_phrases i ON c.lang = i.lang AND c.phrase = i.phrase WHERE longer IS NULL OR 100 * longer < 100 * a
), cuts AS (SELECT *, unnest(range(1, m)) AS k FROM whole
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))
