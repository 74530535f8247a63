"""Preference formatting, with DataFrame functions only.

Input: turns of pairs of conversations, (pair_id, side, turn, role, text) with side ``chosen`` or ``rejected``. The
two sides are joined turn by turn; the prefix ends at the first place whose turns differ in role or text, or where
either side ends. The prefix is rendered once as prompt, each rest as a completion with the spans to train on: those
of assistant turns, everything else being masked.

Turns are compared before anything is gathered, so only the turns of one pair ever meet. A repeated (pair, side,
turn) counts once, by its least (role, text); that is settled by a partial aggregate, so a hot pair does not grow.

Defined results: turns are ordered by number; null roles and texts equal each other in comparison and are rendered
as "user" and empty. A pair without one side has an empty prompt (nothing is common) and no turns there. Identical
sides have empty completions. Turns without pair, number or a known side are left out. Offsets count characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def render(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """(head, body, whole) of a rendered turn; the head is never trained on."""
    head = F.concat(F.lit("<|"), F.coalesce(role, F.lit("user")), F.lit("|>\n"))
    body = F.concat(F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))
    return head, body, F.concat(head, body)


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair.

    Columns: pair_id, prefix_turns, prompt, chosen, rejected (strings), chosen_spans and rejected_spans
    (array<struct<start, stop>>, trained characters of the completion), chosen_turns, rejected_turns.
    """
    one = turns.where("pair_id is not null and turn is not null and side in ('chosen', 'rejected')").groupBy(
        "pair_id", "turn", "side").agg(F.min(F.struct("role", "text")).alias("t"))
    # a side's n-th turn meets the other's n-th turn, whatever their numbers
    one = one.withColumn("at", F.row_number().over(Window.partitionBy("pair_id", "side").orderBy("turn")))
    of = lambda side: F.max(F.when(F.col("side") == side, F.struct("t"))).alias(side)
    places = one.groupBy("pair_id", "at").agg(of("chosen"), of("rejected"))
    same = F.col("chosen").isNotNull() & F.col("chosen").eqNullSafe(F.col("rejected"))
    rendered = {s: render(F.col(f"{s}.t.role"), F.col(f"{s}.t.text")) for s in ("chosen", "rejected")}
    piece = lambda s: F.when(F.col(s).isNotNull(), F.struct(
        "at", rendered[s][2].alias("text"), F.length(rendered[s][0]).alias("head"),
        F.length(rendered[s][2]).alias("size"), F.col(f"{s}.t.role").eqNullSafe(F.lit(TRAINED_ROLE)).alias("train")))
    gathered = places.groupBy("pair_id").agg(
        F.min(F.when(~same, F.col("at"))).alias("differs"),
        F.array_sort(F.collect_list(piece("chosen"))).alias("c"),
        F.array_sort(F.collect_list(piece("rejected"))).alias("r"))
    until = F.coalesce(F.col("differs") - 1, F.size("c"))
    gathered = gathered.withColumn("prefix_turns", until.cast("int"))
    text = lambda a: F.concat_ws("", F.transform(a, lambda x: x["text"]))
    rest = lambda a: F.filter(a, lambda x: x["at"] > F.col("prefix_turns"))
    return gathered.select(
        "pair_id", "prefix_turns", text(F.filter("c", lambda x: x["at"] <= F.col("prefix_turns"))).alias("prompt"),
        text(rest("c")).alias("chosen"), text(rest("r")).alias("rejected"),
        _spans(rest("c")).alias("chosen_spans"), _spans(rest("r")).alias("rejected_spans"),
        F.size("c").alias("chosen_turns"), F.size("r").alias("rejected_turns"))


def _spans(pieces: Column) -> Column:
    """Trained stretches of the joined pieces, by a running offset."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        span = F.array(F.struct((acc["at"] + x["head"]).alias("start"), (acc["at"] + x["size"]).alias("stop")))
        return F.struct((acc["at"] + x["size"]).alias("at"),
                        F.when(x["train"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(pieces, start, add, lambda acc: acc["spans"])


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """Turns of pairs made of plain conversations (conv_id, turn, role, text): pair_id, side, turn, role, text.

    Every conversation is a chosen side. Its rejected side has the same turns, but its last assistant turn holds the
    last assistant text of the neighbour (the conversation whose id differs in the lowest bit), an answer to another
    question; without such a neighbour the turn is left out. Later turns stay on the chosen side only.
    """
    turns = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(
        F.min(F.struct("role", "text")).alias("t")).select("conv_id", "turn", "t.role", "t.text")
    last = turns.where(F.col("role") == TRAINED_ROLE).groupBy("conv_id").agg(
        F.max_by(F.struct("turn", "text"), "turn").alias("a"))
    other = last.select((F.col("conv_id").bitwiseXOR(F.lit(1))).alias("conv_id"), F.struct("a.text").alias("swap"))
    own = last.select("conv_id", F.col("a.turn").alias("last_turn"))
    side = turns.join(own, "conv_id", "left").join(other, "conv_id", "left")
    is_last = F.col("turn") == F.col("last_turn")
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text"), F.lit(True).alias("keep")),
        F.struct(F.lit("rejected").alias("side"),
                 F.when(is_last, F.col("swap.text")).otherwise(F.col("text")).alias("text"),
                 (F.col("last_turn").isNull() | (F.col("turn") < F.col("last_turn"))
                  | (is_last & F.col("swap").isNotNull())).alias("keep")))
    return side.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s")).where(
        "s.keep").select("pair_id", "s.side", "turn", "role", "s.text")
