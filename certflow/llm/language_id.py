"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certflow.llm.tasks import give_back, steps, stored

UNKNOWN = "und"
WORD_CACHE = 200_000
SALTS = 16
_runs = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    found = _runs.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: list[str], order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams that end at each position of the padded words, and of their contexts.

    A word is read as order - 1 start marks, its characters and an end mark. Returns, for
    n = 1 to order, the hashes of the n-grams and of their first n - 1 characters, and the
    number of the word that each position belongs to.
    """
    start, end = "\x02" * (order - 1), "\x03"
    points = np.frombuffer("".join(start + w + end for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    firsts = np.cumsum(lengths + order - 1) - lengths
    at = np.repeat(firsts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    owner = np.repeat(np.arange(len(words)), lengths)

    def folded(ends: np.ndarray, n: int) -> np.ndarray:
        h = np.full(len(ends), 17, np.uint64)
        for k in range(n - 1, -1, -1):
            h = _scrambled(h * np.uint64(0x9E3779B97F4A7C15) + points[ends - k])
        return h

    grams = [folded(at, n) for n in range(1, order + 1)]
    contexts = [folded(at - 1, n - 1) for n in range(1, order + 1)]
    return grams, contexts, owner


@dataclass
class Model:
    """Per language and order, sorted hash arrays with logarithms: of probabilities, and of context weights."""

    order: int
    langs: list[str]
    floor: list[float]
    tables: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    limit: float = float("inf")

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of each word's probability under each language."""
        grams, contexts, owner = gram_hashes(words, self.order)
        # each n-gram is looked up once, and in order, which the sorted arrays answer fastest
        asked = [(*np.unique(g, return_inverse=True), *np.unique(c, return_inverse=True)) for g, c in zip(grams, contexts)]
        out = np.empty((len(words), len(self.langs)))
        for j, tables in enumerate(self.tables):
            p = np.full(len(owner), self.floor[j])
            for (gram, at, context, context_at), (hashes, logs, context_hashes, weights) in zip(asked, tables):
                known, value = _found(hashes, logs, gram)
                seen, weight = _found(context_hashes, weights, context)
                p = np.where(known[at], value[at], p + np.where(seen, weight, 0.0)[context_at])
            out[:, j] = np.bincount(owner, p, len(words))
        return out


def _found(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(asked), bool), np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return keys[at] == asked, values[at]


class Scorer:
    """Cross-entropies of texts; words seen before come from a bounded cache."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.empty((0, len(self.model.langs)))

    def entropies(self, texts: list[str | None]) -> list[tuple[np.ndarray, int] | None]:
        """Nats per character under each language and the number of characters, or None without letters or languages."""
        return [one for _, one in self.scored(texts)]

    def scored(self, texts: list[str | None]) -> list[tuple[bool, tuple[np.ndarray, int] | None]]:
        """Whether a text has letters, and its entropies."""
        split = [words_of(x) for x in texts]
        if not self.model.langs:
            return [(bool(words), None) for words in split]
        new = list({w for words in split for w in words if w not in self.known})
        if len(self.known) + len(new) > WORD_CACHE:
            self._clear()
            new = list({w for words in split for w in words})
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            parts = [self.model.word_scores(new[k:k + 20_000]) for k in range(0, len(new), 20_000)]
            self.table = np.concatenate([self.table, *parts])
        out: list[tuple[bool, tuple[np.ndarray, int] | None]] = []
        for words in split:
            n = sum(map(len, words)) + len(words)
            rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            out.append((bool(words), (-self.table[rows].sum(0) / n, n) if words else None))
        return out


def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0. False for a null id, which is not learned from either."""
    return F.coalesce(_fold(doc_id) == 0, F.lit(False))


def _sample(labelled: DataFrame, docs_per_lang: int) -> DataFrame:
    """The first docs_per_lang rows of each language by a hash of the id."""
    ids = labelled.select("doc_id", "lang").withColumns({"order": F.xxhash64("doc_id"), "salt": F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS))})
    # first within salts: at most SALTS * docs_per_lang ids of a language then meet in one task, at any number of rows
    for keys in (["lang", "salt"], ["lang"]):
        window = Window.partitionBy(*keys).orderBy("order", "doc_id")
        ids = ids.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= docs_per_lang).drop("rank")
    # a table of known size: Spark sends it to every executor as long as it is small
    return labelled.join(stored(ids.select("doc_id").distinct(), "sample-ids"), "doc_id", "left_semi")


def train(labelled: DataFrame, *, order: int = 5, docs_per_lang: int = 1000, calibration_docs: int = 500) -> Model:
    """Fit the models on at most docs_per_lang documents a language, and the rejection on at most calibration_docs others.

    `labelled` has doc_id, lang (neither null) and text. Documents whose crc32 of the id modulo 5
    is 1 calibrate, the others fit. N-grams are counted in the tasks and
    merged by Spark; lower orders count distinct left neighbours; discounts are n1 / (n1 + 2 n2)
    for each language and order. The finished arrays, whose size the sample bounds, come to
    the driver.
    """
    spark = labelled.sparkSession
    sample = _sample(labelled.where(_fold(F.col("doc_id")) != 1), docs_per_lang)
    suffixes, contexts = [f"s{n}" for n in range(1, order + 1)], [f"x{n}" for n in range(1, order + 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text))
            for lang, seen in words.items():
                if not seen:
                    continue
                grams, before, owner = gram_hashes(list(seen), order)
                times = np.fromiter(seen.values(), np.int64, len(seen))[owner]
                _, at, which = np.unique(grams[-1], return_index=True, return_inverse=True)
                total = np.bincount(which, times).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(total),
                     *(pa.array(g[at].view(np.int64)) for g in grams), *(pa.array(x[at].view(np.int64)) for x in before)],
                    ["lang", "c", *suffixes, *contexts])

    counted = sample.select("lang", "text").mapInArrow(
        count, "lang string, c long, " + ", ".join(f"{c} long" for c in (*suffixes, *contexts)))
    levels: dict[int, DataFrame] = {}
    rows = counted.groupBy("lang", f"s{order}").agg(F.sum("c").alias("c"), *(F.first(c).alias(c) for c in (*suffixes[:-1], *contexts)))
    levels[order] = stored(rows, "grams")
    for n in range(order - 1, 0, -1):
        levels[n] = stored(levels[n + 1].groupBy("lang", f"s{n}").agg(
            F.count("*").alias("c"), *(F.first(c).alias(c) for c in (*suffixes[:n - 1], *contexts[:n]))), "grams")

    floor = levels[1].groupBy("lang").agg((-F.log(F.count("*") + 1.0)).alias("floor"))
    lower = floor.select("lang", F.exp("floor").alias("p"))
    parts = []
    for n in range(1, order + 1):
        level = levels[n]
        ones, twos = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
        cut = level.groupBy("lang").agg(F.greatest(F.lit(0.1), F.least(F.lit(0.9), F.when(ones + twos > 0, ones / (ones + 2 * twos)).otherwise(F.lit(0.5)))).alias("d"))
        context = (level.groupBy("lang", f"x{n}").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
                   .join(cut, "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("total")))
        below = lower if n == 1 else lower.withColumnRenamed("key", f"s{n - 1}")
        known = (level.join(context, ["lang", f"x{n}"]).join(below, ["lang"] if n == 1 else ["lang", f"s{n - 1}"])
                 .select("lang", F.col(f"s{n}").alias("key"),
                         ((F.col("c") - F.col("d")) / F.col("total") + F.col("weight") * F.col("p")).alias("p")))
        lower = stored(known, "probabilities")
        parts.append(lower.select("lang", F.lit(n).alias("n"), F.lit(True).alias("gram"), "key", F.log("p").alias("value")))
        parts.append(context.select("lang", F.lit(n).alias("n"), F.lit(False).alias("gram"), F.col(f"x{n}").alias("key"), F.log("weight").alias("value")))
    table = parts[0]
    for part in parts[1:]:
        table = table.union(part)
    floors = dict(floor.collect())
    model = _arrays(table.toArrow(), sorted(floors), floors, order)
    _calibrate(model, _sample(labelled.where(_fold(F.col("doc_id")) == 1), calibration_docs))
    return model


def _arrays(table: pa.Table, langs: list[str], floors: dict[str, float], order: int) -> Model:
    lang = np.array(table["lang"].to_pylist(), object)
    n, gram = table["n"].to_numpy(), table["gram"].to_numpy()
    keys, values = table["key"].to_numpy().view(np.uint64), table["value"].to_numpy()
    tables = []
    for one in langs:
        mine = lang == one
        tables.append([])
        for k in range(1, order + 1):
            pair = []
            for is_gram in (True, False):
                at = np.flatnonzero(mine & (n == k) & (gram == is_gram))
                at = at[np.argsort(keys[at])]
                pair += [keys[at], values[at]]
            tables[-1].append(tuple(pair))
    return Model(order, langs, [floors[x] for x in langs], tables)


def _calibrate(model: Model, docs: DataFrame) -> None:
    """Mean and spread of the cross-entropy per language, and the largest deviation that is not rejected.

    A document's deviation is (entropy - mean) * sqrt(characters) / spread. The limit is 2
    times the largest deviation among documents predicted as labelled, and 12 at least.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in steps(batches):
            made = []
            for lang, one in zip(batch.column("lang").to_pylist(), scorer.entropies(batch.column("text").to_pylist())):
                if one and shared.value.langs[int(np.argmin(one[0]))] == lang:
                    made.append({"lang": lang, "entropy": float(one[0].min()), "n": one[1]})
            yield pa.RecordBatch.from_pylist(made, pa.schema([("lang", pa.string()), ("entropy", pa.float64()), ("n", pa.int64())]))

    seen = stored(docs.select("lang", "text").mapInArrow(score, "lang string, entropy double, n long"), "calibration")
    mean = seen.groupBy("lang").agg((F.sum(F.col("entropy") * F.col("n")) / F.sum("n")).alias("mean"))
    off = F.col("entropy") - F.col("mean")
    spread = seen.join(mean, "lang").groupBy("lang", "mean").agg(F.sqrt(F.avg(off * off * F.col("n"))).alias("spread"))
    rows = {r["lang"]: (r["mean"], max(r["spread"], 1e-6)) for r in spread.collect()}
    worst = seen.join(spread, "lang").agg(F.max(off * F.sqrt("n") / F.greatest("spread", F.lit(1e-6)))).first()[0]
    model.mean = np.array([rows.get(x, (np.inf, 1.0))[0] for x in model.langs])
    model.spread = np.array([rows.get(x, (np.inf, 1.0))[1] for x in model.langs])
    model.limit = max(12.0, 2.0 * worst) if worst is not None else float("inf")


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` with lang_pred, score and accepted.

    lang_pred is the language of the lowest cross-entropy per character (the first by name at a
    tie), or `und` where the text is null or holds no letter, or nothing was learned. score is
    the share of that language in exp(-10 * entropy) over all, 0 for `und`. accepted is false for
    `und` (but true where nothing was learned and the text has letters) and where the entropy lies farther above the language's mean than the calibrated
    limit allows for the text's length. Whole texts are read. A column of `docs` with the name of a new
    one is replaced.
    """
    made = ["lang_pred", "score", "accepted"]
    docs = docs.drop(*made)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = Scorer(model)
        for batch in steps(batches):
            rows = []
            texts = batch.column(at).to_pylist()
            for words, one in scorer.scored(texts):
                if one is None:
                    rows.append((UNKNOWN, 0.0, words and not model.langs))
                    continue
                entropy, n = one
                best = int(np.argmin(entropy))
                share = np.exp(-10 * (entropy - entropy[best]))
                far = (entropy[best] - model.mean[best]) * np.sqrt(n) / model.spread[best]
                rows.append((model.langs[best], float(1 / share.sum()), not far > model.limit))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array([r[2] for r in rows], pa.bool_())], [*batch.schema.names, *made])
        del scorer
        give_back()

    schema = T.StructType(list(docs.schema))
    for name, kind in zip(made, ("string", "double", "boolean")):
        schema = schema.add(name, kind)
    return docs.mapInArrow(label, schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **settings: int) -> DataFrame:
    """Train on the labelled documents that are not held out, predict all: doc_id, held_out, lang_pred, score, accepted."""
    model = train(training_rows(docs, doc_id, text, lang), **settings)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return predict(source, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def training_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
