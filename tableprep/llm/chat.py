"""Preference formatting of conversations (operator 3).

A pair of a chosen and a rejected conversation is rendered with its longest common
prefix of turns as the prompt, once, and each side's other turns as a completion.
The mask of a completion lists the spans to train on: what assistant turns say,
with the end mark that the model must learn to write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, CLOSE, MARK = "<|{role}|>\n", "<|end|>\n", "<|"


def conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, turns): a conversation's turns (role, text) in order of turn, then role
    and text, so equal rows stay and ties are settled. Null roles are 'user', null
    texts ''; rows with a null conversation id belong to none and are left out. One
    conversation's turns meet in one row, as they are one text of the result."""
    t = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("n"),
        F.coalesce(F.col(role_col), F.lit("user")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "role", "text"))).alias("all"))
            .select("conv_id", F.transform("all", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns")))


def _head(turn: Column) -> Column:
    before, after = OPEN.split("{role}")
    return F.concat(F.lit(before), turn["role"], F.lit(after))


def _body(turn: Column) -> Column:
    # a mark inside a text may not look like the template's
    return F.concat(F.replace(turn["text"], F.lit(MARK), F.lit("<\\|")), F.lit(CLOSE))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns: Column) -> Column:
    """[start, end) in code points of the rendered turns, assistant bodies only."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(_head(t))
        end = start + F.length(_body(t))
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step)["spans"]


def format_preferences(convs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, status, prefix_turns, prompt, chosen, rejected,
    chosen_mask, rejected_mask) for pairs whose conversations both exist. The prompt
    is the longest common prefix of turns (equal role and text). status is 'ok',
    'identical' (nothing differs), 'chosen_empty' or 'rejected_empty' (one is the
    other's prefix, so its completion is '' with an empty mask)."""
    a = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a"))
    b = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b"))
    both = pairs.join(a, "chosen_id").join(b, "rejected_id")
    same = F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y))
    n = F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same).cast("long")).cast("int")
    both = both.withColumn("prefix_turns", n)
    for side in ("a", "b"):
        both = both.withColumn(f"{side}_rest", F.slice(side, F.col("prefix_turns") + 1, F.greatest(F.size(side) - F.col("prefix_turns"), F.lit(0))))
    left, right = F.size("a_rest") == 0, F.size("b_rest") == 0
    status = F.when(left & right, "identical").when(left, "chosen_empty").when(right, "rejected_empty").otherwise("ok")
    return both.select("chosen_id", "rejected_id", status.alias("status"), "prefix_turns",
                       _render(F.slice("a", 1, F.col("prefix_turns"))).alias("prompt"),
                       _render(F.col("a_rest")).alias("chosen"), _render(F.col("b_rest")).alias("rejected"),
                       _mask(F.col("a_rest")).alias("chosen_mask"), _mask(F.col("b_rest")).alias("rejected_mask"))
