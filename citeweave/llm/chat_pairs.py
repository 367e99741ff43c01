"""Preference formatting: common prompt and paired masked completions, by DataFrame functions.

Two conversations, one chosen and one rejected, are compared turn by turn.  The longest
common prefix of turns is rendered once as the prompt; what follows in each is its
completion.  A row is one rendered turn, so no conversation has to fit in one task; only
the assistant's words in completions, with their closing mark, are to be learned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import named

# Fixed values of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def neighbour_pairs(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``pair_id, chosen_id, rejected_id``: conversations 2k and 2k + 1, where both exist.

    Ids are halved in whole numbers, so large and negative ones are paired as well.
    """
    conv = named(conv_col).cast("bigint")
    pairs = turns.select(conv.alias("conv")).where("conv is not null").groupBy(
        F.shiftright("conv", 1).alias("pair_id")).agg(
        F.min("conv").alias("chosen_id"), F.max("conv").alias("rejected_id"))
    return pairs.where("chosen_id <> rejected_id")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE + "\n"))


def preference_turns(turns: DataFrame, pairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rendered turns of preference pairs.

    ``pairs`` has ``pair_id, chosen_id, rejected_id``.  Turns follow their numbers; rows
    without a number come last and together.  A turn is common if both conversations have
    it with the same rows (role and text, in any number and order); the prompt ends
    before the first turn that is not.  Null roles and texts count as empty.  Equal
    conversations are all prompt; conversations without a common turn have none.  Rows
    without a conversation id, and conversations in no pair, are in no result.  Repeated
    rows are rendered as often as they stand.

    Returns ``pair_id, chosen_id, rejected_id, part, turn, role, rendered, learn_from,
    learn_to``: ``part`` is ``prompt``, ``chosen`` or ``rejected``; characters from
    ``learn_from`` up to ``learn_to`` of ``rendered`` are learned, none where they are equal.
    """
    rows = turns.select(named(conv_col).cast("bigint").alias("conv"), named(turn_col).cast("bigint").alias("turn"),
                        F.coalesce(named(role_col), F.lit("")).alias("role"),
                        F.coalesce(named(text_col), F.lit("")).alias("text"))
    sides = pairs.select("pair_id", "chosen_id", "rejected_id", F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("chosen_id").alias("conv")),
        F.struct(F.lit("rejected").alias("side"), F.col("rejected_id").alias("conv")))).alias("at")).select(
        "pair_id", "chosen_id", "rejected_id", "at.side", "at.conv")
    met = rows.join(sides, "conv").withColumn("place", F.coalesce("turn", F.lit((1 << 63) - 1)))

    def of(side: str, value: Column) -> Column:
        return F.when(F.col("side") == side, value)

    def content(side: str) -> Column:
        """What a side has at a turn, independent of the order of its rows."""
        row = F.struct("role", "text")
        return F.struct(F.count(of(side, F.lit(1))).alias("n"), F.min(of(side, row)).alias("low"),
                        F.max(of(side, row)).alias("high"),
                        F.sum(of(side, F.xxhash64("role", "text").cast("decimal(20,0)"))).alias("hash"))

    at_turn = met.groupBy("pair_id", "place").agg(content("chosen").alias("one"), content("rejected").alias("two"))
    ends = at_turn.where(~F.col("one").eqNullSafe(F.col("two"))).groupBy("pair_id").agg(
        F.min("place").alias("prompt_end"))
    placed = met.join(ends, "pair_id", "left")
    common = F.col("prompt_end").isNull() | (F.col("place") < F.col("prompt_end"))
    # The prompt stands in both conversations; it is taken from the chosen one.
    wanted = placed.withColumn("part", F.when(common, F.lit("prompt")).otherwise(F.col("side"))).where(
        (F.col("part") != "prompt") | (F.col("side") == "chosen"))
    whole = rendered(F.col("role"), F.col("text"))
    head = F.length(F.lit(OPEN)) + F.length("role") + 1
    learns = (F.col("part") != "prompt") & (F.col("role") == LEARNED_ROLE)
    end = head + F.length("text") + F.length(F.lit(CLOSE))
    return wanted.select("pair_id", "chosen_id", "rejected_id", "part", "turn", "role", whole.alias("rendered"),
                         F.when(learns, head).otherwise(0).alias("learn_from"),
                         F.when(learns, end).otherwise(0).alias("learn_to"))


def preference_examples(segments: DataFrame) -> DataFrame:
    """One row per pair: ``prompt, chosen, rejected`` texts, from the rendered turns.

    A pair's conversations are brought together here, so they must fit in one row.
    """
    place = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "rendered")

    def text(part: str) -> Column:
        own = F.array_sort(F.collect_list(F.when(F.col("part") == part, place)))
        return F.concat_ws("", F.transform(own, lambda turn: turn["rendered"])).alias(part)

    return segments.groupBy("pair_id", "chosen_id", "rejected_id").agg(
        text("prompt"), text("chosen"), text("rejected"))
