"""Preference pairs for training: one prompt, two masked completions.

A pair is a chosen and a rejected conversation. Their longest common prefix of
turns (equal role and text at equal positions) is rendered once, as the prompt;
what follows on either side is rendered as its completion. Loss falls on the
assistant's words in the completions alone: the mask lists their character
spans (code points, end exclusive), so headers, other speakers and the prompt
carry none.

Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """``(pair_id, side, turn, role, text)`` to one row for each pair that has a chosen side:
    ``pair_id, common_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    side is ``chosen`` or ``rejected``; rows of other sides are left out, and so
    are rows whose pair is null. Turns of a side are taken in the order of
    turn, role and text (nulls first), wherever their numbers start and whether
    or not some are missing or repeated. A null role is ``unknown``, a null text
    is empty. Equal sides share all turns and have empty completions; a pair
    without a rejected side has an empty prompt, since nothing is shared.
    """
    rows = turns.select(
        "pair_id", "side", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).filter("pair_id is not null and side in ('chosen', 'rejected')")
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    placed = rows.withColumn("at", F.row_number().over(order))
    side = lambda name: F.max(F.when(F.col("side") == name, F.struct("role", "text")))
    aligned = placed.groupBy("pair_id", "at").agg(side("chosen").alias("c"), side("rejected").alias("r"))
    turn = F.struct("at", "c", "r", (~F.col("c").eqNullSafe(F.col("r"))).alias("differs"))
    both = aligned.groupBy("pair_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    length = F.size("turns")
    first = F.array_position(F.transform("turns", lambda t: t["differs"]), True).cast("int")
    both = both.filter(F.exists("turns", lambda t: t["c"].isNotNull())).withColumn(
        "common_turns", F.when(first == 0, length).otherwise(first - 1))
    prompt = F.array_join(
        F.transform(F.slice("turns", 1, F.col("common_turns")), lambda t: rendered(t["c"]["role"], t["c"]["text"])), "")
    out = both.withColumn("rest", F.slice("turns", F.col("common_turns") + 1, F.greatest(length, F.lit(1))))
    return out.select(
        "pair_id", F.col("common_turns").cast("long").alias("common_turns"), prompt.alias("prompt"),
        _completion("c").alias("chosen"), _completion("r").alias("rejected"),
        _mask("c").alias("chosen_mask"), _mask("r").alias("rejected_mask"))


def _side(name: str) -> Column:
    return F.transform(F.filter("rest", lambda t: t[name].isNotNull()), lambda t: t[name])


def _completion(name: str) -> Column:
    return F.array_join(F.transform(_side(name), lambda t: rendered(t["role"], t["text"])), "")


def _mask(name: str) -> Column:
    """``start:end`` of what the assistant says, comma-joined."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + len(OPEN) + F.char_length(t["role"]) + len(MIDDLE)
        end = begin + F.char_length(t["text"])
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        out = F.when(t["role"] == "assistant", F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct((end + len(CLOSE)).alias("at"), out.alias("out"))

    return F.aggregate(_side(name), start, step, lambda s: F.array_join(s["out"], ","))


def spliced(conversations: DataFrame) -> DataFrame:
    """Pairs out of plain conversations ``(conv_id, turn, role, text)``.

    Conversation c is the chosen side of pair c. Its rejected side starts with
    the same turns and goes on, from turn 1 + c mod 3, with those of the
    neighbour c xor 1. Every row takes part, without a join.
    """
    conv = F.col("conv_id").cast("long")
    cut = lambda c: 1 + F.pmod(c, F.lit(3))
    other = conv.bitwiseXOR(F.lit(1))
    chosen = F.struct(conv.alias("pair_id"), F.lit("chosen").alias("side"))
    kept = F.when(F.coalesce("turn", F.lit(0)) < cut(conv), F.struct(conv.alias("pair_id"), F.lit("rejected").alias("side")))
    given = F.when(F.coalesce("turn", F.lit(0)) >= cut(other), F.struct(other.alias("pair_id"), F.lit("rejected").alias("side")))
    places = F.filter(F.array(chosen, kept, given), lambda p: p.isNotNull())
    return conversations.select(F.explode(places).alias("p"), "turn", "role", "text").select("p.*", "turn", "role", "text")
