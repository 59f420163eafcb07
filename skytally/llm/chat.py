"""Preference pairs for training: the turns both conversations share as prompt, the rest as masked completions.

A pair is two conversations, chosen and rejected. Their longest common prefix of turns (same place, role and text)
is rendered once; each side's remaining turns are its completion. The mask gives the ranges of code points in a
completion that are learnt: what the assistant says, with its end marker. Everything is DataFrame operations.

Turns are taken in order of ``turn``, then role and text; repeated rows are repeated turns. A null turn number comes
first, a null role or text counts as empty. A pair that has only one side gets an empty completion for the other one.
Rows without pair id are ignored. An empty table gives an empty result. Other columns are dropped.
A pair is one training example and is rendered in one row, so a pair must fit in one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _clean(text: Column) -> Column:
    """Text in which nobody can write a control marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), _clean(role), F.lit("\n"), _clean(text), F.lit(END + "\n"))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """Turns (pair_id, side, turn, role, text), side chosen or rejected, to one row per pair.

    Columns: pair_id, n_common (turns in the prompt), prompt, chosen, chosen_mask, rejected, rejected_mask.
    """
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    known = turns.filter(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected"))
    read = known.select(
        "pair_id",
        "side",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    piece = rendered(F.col("role"), F.col("text"))
    # One shuffle by pair serves the window and the grouping.
    placed = read.repartition("pair_id").withColumns(
        {
            "place": F.row_number().over(order),
            "begin": F.coalesce(
                F.sum(F.length(piece)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        }
    )
    turn = F.struct("place", "role", "text", "begin")

    def side(name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, turn))).alias(f"{name}_turns")

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False))

    agrees = F.zip_with("chosen_turns", "rejected_turns", same)
    first_other = F.array_position(agrees, False)
    pairs = (
        placed.groupBy("pair_id")
        .agg(side("chosen"), side("rejected"))
        .withColumn("n_common", F.when(first_other > 0, first_other - 1).otherwise(F.size(agrees)).cast("int"))
    )

    def text_of(turns: Column) -> Column:
        return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")

    def rest(name: str) -> Column:
        return F.filter(f"{name}_turns", lambda t: t["place"] > F.col("n_common"))

    def mask(name: str) -> Column:
        # Both sides' prompts are equally long, so what follows begins where the turn after the prompt does.
        base = F.get(F.col(f"{name}_turns"), F.col("n_common"))["begin"]

        def learnt(t: Column) -> Column:
            head = t["begin"] - base + len(START) + F.length(_clean(t["role"])) + 1
            return F.struct(head.alias("start"), (head + F.length(_clean(t["text"])) + len(END)).alias("end"))

        return F.transform(F.filter(rest(name), lambda t: t["role"] == "assistant"), learnt)

    return pairs.select(
        "pair_id",
        "n_common",
        text_of(F.slice("chosen_turns", F.lit(1), F.col("n_common"))).alias("prompt"),
        text_of(rest("chosen")).alias("chosen"),
        mask("chosen").alias("chosen_mask"),
        text_of(rest("rejected")).alias("rejected"),
        mask("rejected").alias("rejected_mask"),
    )


def against_partner(conversations: DataFrame) -> DataFrame:
    """Turns of one pair for each conversation, where nobody has rated answers.

    Chosen is the conversation, every turn of it. Rejected keeps its first turns, how many is a hash of the id modulo
    one more than their number, and goes on from there like the partner conversation, whose id differs in the last bit:
    answers to other questions. Without a partner, or with a shorter one, the rejected side ends earlier. A conversation
    is one training example, so its turns are ordered in one task. Turns take their place as number.
    """
    turns = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    own = Window.partitionBy("conv_id")
    place = F.row_number().over(own.orderBy(F.asc_nulls_first("turn"), "role", "text"))
    hashed = F.conv(F.substr(F.sha2(F.col("conv_id").cast("string"), 256), F.lit(1), F.lit(8)), 16, 10).cast("long")
    kept = F.pmod(hashed, F.count(F.lit(1)).over(own) + 1)
    placed = turns.select("conv_id", place.alias("turn"), "role", "text", kept.alias("kept"))

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col("conv_id").alias("pair_id"), F.lit(name).alias("side"), "turn", "role", "text")

    places = placed.filter("turn = 1").select("conv_id", "kept")
    partner = placed.drop("kept").withColumn("conv_id", F.col("conv_id").bitwiseXOR(F.lit(1)))
    return (
        side(placed, "chosen")
        .unionByName(side(placed.filter("turn <= kept"), "rejected"))
        .unionByName(side(partner.join(places, "conv_id").filter("turn > kept"), "rejected"))
    )


def whole_conversations(conversations: DataFrame) -> DataFrame:
    """Turns of one pair for each conversation, every turn kept: the conversation against its whole partner.

    The partner's id differs in the last bit; without a partner the rejected side is empty. Turns after the last
    answer, null and equal turn numbers stay, so prefixes end wherever the two conversations part.
    """
    turns = conversations.select("conv_id", "turn", "role", "text").filter("conv_id is not null")
    chosen = turns.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    other = F.col("conv_id").bitwiseXOR(F.lit(1)).alias("pair_id")
    rejected = turns.select(other, F.lit("rejected").alias("side"), "turn", "role", "text")
    # A pair for each conversation, none for partners that don't exist.
    rejected = rejected.join(chosen.select("pair_id").distinct(), "pair_id", "left_semi")
    return chosen.unionByName(rejected)
