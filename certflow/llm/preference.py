"""Preference pairs for chat training: one prompt, two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Conversations per bucket in which neighbours are found for ids that are no whole numbers.
BUCKET = 1000

HEAD, BREAK, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"


def rendered(turn: Column) -> Column:
    """A turn as head, role, line feed, text, tail. Marks inside role and text lose their bars, so none can be forged."""
    plain = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|(im_start|im_end)\|>", "<$1>")
    return F.concat(F.lit(HEAD), plain(turn["role"]), F.lit(BREAK), plain(turn["text"]), F.lit(TAIL))


def _turns(conversations: DataFrame, key: str, turn: str, role: str, text: str, name: str) -> DataFrame:
    rows = conversations.select(F.col(key).alias("pair_id"), F.struct(
        F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).alias("turn"))
    return rows.groupBy("pair_id").agg(F.transform(
        F.sort_array(F.collect_list("turn")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name))


def _masks(turns: Column, from_: Column, trained: str) -> Column:
    """Spans [begin, end) in code points of the completion's text that are trained on: texts and tails of the trained role."""
    parts = F.slice(turns, from_ + 1, F.size(turns))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        whole = F.char_length(rendered(t)).cast("long")
        head = F.char_length(F.concat(F.lit(HEAD), F.regexp_replace(F.coalesce(t["role"], F.lit("")), r"<\|(im_start|im_end)\|>", "<$1>"), F.lit(BREAK))).cast("long")
        # the line feed after the end mark is not trained on
        span = F.struct((state["at"] + head).alias("begin"), (state["at"] + whole - 1).alias("end"))
        return F.struct((state["at"] + whole).alias("at"),
                        F.when(t["role"].eqNullSafe(F.lit(trained)), F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(parts, start, step)["spans"]


def preference_pairs(
    chosen: DataFrame, rejected: DataFrame, pair_id: str = "pair_id", turn: str = "turn", role: str = "role",
    text: str = "text", *, trained: str = "assistant",
) -> DataFrame:
    """One row per pair: prompt once, both completions with the spans to train on.

    `chosen` and `rejected` hold one row per turn. The longest prefix of turns that both
    conversations share (equal role and text, nulls equal) is the prompt; what follows in each is its
    completion. Columns: pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected,
    rejected_mask (arrays of begin, end in code points of the completion), is_pair (true if
    both completions hold a turn of the trained role).

    Turns are ordered by turn, role and text, nulls first; repeated rows are turns of their own.
    Null roles and texts render as empty. A pair of which one side is missing has an empty other
    conversation and so an empty prompt. Rows with a null pair_id are left out, as they belong
    to no pair. Extra columns are ignored. A conversation is one training example, so its turns meet in one row.
    """
    one = _turns(chosen.where(F.col(pair_id).isNotNull()), pair_id, turn, role, text, "c")
    two = _turns(rejected.where(F.col(pair_id).isNotNull()), pair_id, turn, role, text, "r")
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = one.join(two, "pair_id", "full").select(
        "pair_id", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    equal = F.zip_with(F.slice("c", F.lit(1), shorter), F.slice("r", F.lit(1), shorter), lambda x, y: x.eqNullSafe(y))
    first_other = F.array_position(equal, False)
    both = both.withColumn("n", F.when(first_other > 0, first_other - 1).otherwise(shorter).cast("int"))
    render = lambda turns: F.array_join(F.transform(turns, rendered), "")
    rest = lambda name: F.slice(F.col(name), F.col("n") + 1, F.size(name))
    has = lambda name: F.exists(rest(name), lambda t: t["role"].eqNullSafe(F.lit(trained)))
    return both.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"), render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        render(rest("c")).alias("chosen"), _masks(F.col("c"), F.col("n"), trained).alias("chosen_mask"),
        render(rest("r")).alias("rejected"), _masks(F.col("r"), F.col("n"), trained).alias("rejected_mask"),
        (has("c") & has("r")).alias("is_pair"))


def swapped_answers(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rejected conversations made of `conversations`: the last assistant turn has the text of the neighbour's.

    The neighbour of conversation 2k is 2k + 1 and the other way round. Ids of other types are hashed into
    buckets of about 1,000 conversations with an answer, in which the first two by id are neighbours, then the
    next two; the last of an odd number has none. Conversations without a neighbour, an assistant turn or an
    id stay as they are. Of several last turns, that with the largest text counts.
    """
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    last = (rows.where(F.col("role") == "assistant").groupBy("conv_id")
            .agg(F.max("turn").alias("last_turn"), F.max_by("text", F.struct("turn", "text")).alias("answer")))
    if isinstance(rows.schema["conv_id"].dataType, T.IntegralType):
        other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("answer").alias("other_answer"))
        ends = last.join(other, "conv_id").select("conv_id", "last_turn", "other_answer")
    else:
        named = last.where(F.col("conv_id").isNotNull())
        buckets = named.count() // BUCKET + 1
        bucket = Window.partitionBy("bucket").orderBy("conv_id")
        placed = (named.withColumn("bucket", F.pmod(F.xxhash64("conv_id"), F.lit(buckets)))
                  .withColumn("place", F.row_number().over(bucket)))
        own = F.struct("answer")
        other = F.when(F.col("place") % 2 == 1, F.lead(own).over(bucket)).otherwise(F.lag(own).over(bucket))
        ends = placed.withColumn("other", other).where(F.col("other").isNotNull()).select(
            "conv_id", "last_turn", F.col("other.answer").alias("other_answer"))
    at_end = (F.col("role") == "assistant") & (F.col("turn") == F.col("last_turn"))
    return rows.join(ends, "conv_id", "left").select(
        "conv_id", "turn", "role", F.when(at_end, F.col("other_answer")).otherwise(F.col("text")).alias("text"))
