"""Preference pairs from chosen and rejected conversations, with DataFrame functions only.

The longest common prefix of turns is rendered once, as the prompt; what follows is
rendered as two completions with masks that leave the assistant's turns to train on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import bind

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def by_conversation(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as structs (turn, role, text).

    Null role and text count as empty; turns with equal numbers go by role, then text,
    and repeats stay. Rows without a conv_id belong to no conversation and are left out.
    """
    lean = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return lean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal in role and text."""
    n = F.least(F.size(a), F.size(b))
    differs = F.zip_with(
        F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x["role"] != y["role"]) | (x["text"] != y["text"])
    )
    first = F.array_position(differs, True)
    return F.when(first > 0, first - 1).otherwise(n).cast("long")


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))))


def trained_spans(turns: Column) -> Column:
    """start:end, comma-joined, of what a model learns in the rendered turns: the assistant's texts with their closing mark.

    Code points, end exclusive.
    """
    head = lambda t: F.lit(len(OPEN + MIDDLE)) + F.length(t["role"])
    tail = lambda t: F.length(t["text"]) + F.lit(len(CLOSE))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def step(s, t):
        lo = s["at"] + head(t)
        hi = lo + tail(t)
        span = F.concat(lo.cast("string"), F.lit(":"), hi.cast("string"))
        both = F.when(s["spans"] == "", span).otherwise(F.concat(s["spans"], F.lit(","), span))
        return F.struct(hi.alias("at"), F.when(t["role"] == "assistant", both).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def pair_up(turns: DataFrame, pair_id: Column, is_chosen: Column) -> DataFrame:
    """Pairs out of one table (conv_id, turn, role, text).

    pair_id and is_chosen are expressions over conv_id. Result, nulls and ties as told
    in `by_conversation`; a pair with one side only has null ids, completion and mask on
    the other, n_prompt_turns 0, and the whole conversation as the completion. Equal
    conversations leave two empty completions. Other columns are not read; an empty
    table gives an empty result.
    """
    convs = by_conversation(turns).withColumn("pair_id", pair_id).withColumn("picked", is_chosen)
    # One shuffle more, by pair: each side of a pair is one row by now.
    sides = convs.groupBy("pair_id").agg(
        *[F.min(F.when(F.col("picked") == flag, F.struct("conv_id", "turns"))).alias(name) for name, flag in (("c", True), ("r", False))]
    )
    n = F.when(F.col("c").isNotNull() & F.col("r").isNotNull(), common_turns(F.col("c.turns"), F.col("r.turns"))).otherwise(F.lit(0).cast("long"))
    cut = sides.withColumn("n_prompt_turns", n)
    k = F.col("n_prompt_turns").cast("int")
    rest = lambda s: F.slice(F.col(f"{s}.turns"), k + 1, F.greatest(F.size(f"{s}.turns") - k, F.lit(0)))
    return cut.select(
        "pair_id",
        F.col("c.conv_id").alias("chosen_id"),
        F.col("r.conv_id").alias("rejected_id"),
        "n_prompt_turns",
        render(F.slice(F.coalesce("c.turns", "r.turns"), F.lit(1), k)).alias("prompt"),
        F.when(F.col("c").isNotNull(), render(rest("c"))).alias("chosen"),
        F.when(F.col("r").isNotNull(), render(rest("r"))).alias("rejected"),
        F.when(F.col("c").isNotNull(), bind(rest("c"), trained_spans)).alias("chosen_mask"),
        F.when(F.col("r").isNotNull(), bind(rest("r"), trained_spans)).alias("rejected_mask"),
    )
