"""Preference examples: what a chosen and a rejected conversation share is the prompt, the rest are two completions.

The longest common prefix of turns is rendered once. Each completion comes with the spans of
its characters that bear loss: the texts of assistant turns with their end mark.

Defined results: rows that agree in conversation, turn, role and text count once; others of one turn order by
role and text (NULLs last); a NULL turn number orders last; a NULL role is ``unknown`` and a NULL text empty. A conversation
that no pair names, or a pair of which one side is missing, gives no example. If one side is
a prefix of the other, its completion is empty. Other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit(END))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as one array."""
    said = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text").distinct()
    item = F.struct(
        F.col("turn").isNull().alias("last"), F.col("turn"), F.col("role").isNull().alias("r"), F.col("role").alias("own_role"),
        F.col("text").isNull().alias("t"), F.col("text").alias("own_text"),
        F.struct(F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"))
    once = said.select("conv_id", item.alias("item"))
    return once.groupBy("conv_id").agg(F.array_sort(F.collect_list("item")).alias("items")).select(
        "conv_id", F.transform("items", lambda t: t["said"]).alias("turns"))


def _string(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")


def _loss_spans(turns: Column) -> Column:
    """start and end, in characters of the rendered turns, of what assistant turns say."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done: Column, turn: Column) -> Column:
        end = done["at"] + F.length(rendered(turn["role"], turn["text"]))
        start = done["at"] + F.length(turn["role"]) + 5
        span = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.struct(end.cast("int").alias("at"), F.when(
            turn["role"] == "assistant", F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, empty, add, lambda done: done["spans"])


def preference_examples(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair (pair_id, chosen_id, rejected_id): prompt, chosen, rejected, their loss spans, n_shared turns."""
    whole = conversations(turns)
    chosen = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    rejected = whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    both = pairs.join(chosen, "chosen_id").join(rejected, "rejected_id")
    same = F.zip_with("c", "r", lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    stop = F.array_position(same, False)
    shared = F.when(stop > 0, stop - 1).otherwise(F.size("c")).cast("int")
    cut = both.withColumn("n_shared", shared)
    rest = lambda side: F.slice(F.col(side), F.col("n_shared") + 1, F.size(side))
    return cut.select(
        "pair_id", "chosen_id", "rejected_id", "n_shared", _string(F.slice("c", F.lit(1), F.col("n_shared"))).alias("prompt"),
        _string(rest("c")).alias("chosen"), _string(rest("r")).alias("rejected"),
        _loss_spans(rest("c")).alias("chosen_loss"), _loss_spans(rest("r")).alias("rejected_loss"))


def neighbouring_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of the conversations with ids 2n (chosen) and 2n + 1 (rejected), for a table without ratings."""
    ids = turns.where("conv_id IS NOT NULL").select((F.floor(F.col("conv_id") / 2)).alias("pair_id")).distinct()
    return ids.select("pair_id", (F.col("pair_id") * 2).alias("chosen_id"), (F.col("pair_id") * 2 + 1).alias("rejected_id"))
