"""A training corpus from `documents`: rules, language, near duplicates, mixture, tokens."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certflow.llm import bpe, language_id, mixing, near_dedup, quality
from certflow.llm.tasks import stored

TOKENIZER_FILE = bpe.tokenizer_file("word_bpe_49k.json")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Stage) -> Stage:
    """Columns besides OWN pass through the stage as one struct, so that no name of theirs can clash with one of the stage's own."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        column = lambda c: docs[f"`{c}`"]
        extra = [c for c in docs.columns if c not in OWN]
        if not extra:
            return stage(spark, docs, sf_dir)
        made = stage(spark, docs.select(*[column(c) for c in OWN if c in docs.columns], F.struct(*map(column, extra)).alias("extra")), sf_dir)
        return made.select(*[F.col(c) if c in OWN else F.col("extra").getField(c).alias(c) for c in docs.columns])

    return run


@keeps_columns
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines leave the text; documents that the rules reject leave the corpus."""
    return quality.clean_documents(docs)


@keeps_columns
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`lang` becomes the predicted language; documents without a letter or unlike their language leave."""
    model = language_id.train(language_id.training_rows(docs))
    return language_id.predict(docs, model).where("accepted").select(
        *[F.col("lang_pred").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


@keeps_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that with the smallest doc_id (nulls last); shingles of five words, similarity 0.8.

    Rows are told apart by a stored key of their own, so repeated and null ids decide nothing for other rows.
    """
    keyed = stored(docs.withColumn("row_key", F.monotonically_increasing_id()), "keyed-rows")
    grouped = near_dedup.near_duplicates(keyed, "row_key").select(F.col("doc_id").alias("row_key"), "component_id")
    ranks = keyed.select("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "row_key").alias("rank"))
    kept = stored(grouped.join(ranks, "row_key").groupBy("component_id").agg(F.min("rank").alias("rank")).select("rank.row_key"), "kept-rows")
    return keyed.join(kept, "row_key", "left_semi").select(docs.columns)


@keeps_columns
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources take their target shares; a document can stay in part, or up to three times."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of each text."""
    encoded = bpe.encode_texts(docs, TOKENIZER_FILE)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Models, signatures and tokens have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
