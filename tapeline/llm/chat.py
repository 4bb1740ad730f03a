"""Chat formatting: collapse of cumulative snapshots, then rendering. DataFrame functions only.

A chat that is logged after each turn leaves conversations that are prefixes of longer ones. Every conversation gets a
rolling hash of each of its turn prefixes; a conversation whose whole hash is a proper prefix of another one goes, and of
equal ones the smallest conv_id stays. The rolling hash is a sum of hashes of (position, turn) modulo 2^32 in four lanes, so
that prefix sums over ranges give it: no task holds a conversation, whatever its length, and no sum outgrows its lane,
whatever the table's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import pick, prefix_sums
from tapeline.session import staged

#: Turns of one output row; longer conversations go on in the next row.
SEGMENT_TURNS = 64
LANES = ("a", "b", "c", "d")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Turns in order of (conv_id, turn, role, text hash) with ``at``, their place among all turns of the table."""
    rows = pick(turns, "conv_id", "turn", "role", "text").withColumn("hash", F.xxhash64("text"))
    return prefix_sums(rows, [F.col(c) for c in ("conv_id", "turn", "role", "hash")], {"at": F.lit(1)}, "chat-turns")


def prefix_hashes(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, first, turns, lanes) of whole conversations; (turns, lanes) of each proper prefix of each conversation."""
    first = numbered.groupBy("conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("turns"))
    slim = numbered.select("conv_id", "at", F.xxhash64("role", "text").alias("x"), F.xxhash64("text", "role", F.lit(1)).alias("y"))
    slim = slim.join(first, slim["conv_id"].eqNullSafe(first["conv_id"])).drop(first["conv_id"])
    pos = F.col("at") - F.col("first")
    low = F.lit(0xFFFFFFFF).cast("bigint")
    lane = [F.xxhash64(pos, c).bitwiseAND(low) if half else F.shiftrightunsigned(F.xxhash64(pos, c), 32) for c in ("x", "y") for half in (0, 1)]
    rolled = prefix_sums(slim.withColumns(dict(zip((f"_h{k}" for k in LANES), lane))), [F.col("at")], {k: F.col(f"_h{k}") for k in LANES}, "chat-hashes", 1 << 32)
    rolled = staged(rolled.select("conv_id", "first", "turns", (F.col("at") - F.col("first")).alias("pos"), *LANES, *[f"_h{k}" for k in LANES]), "chat-rolled")
    # what stood before a conversation's first turn is taken off, modulo 2^32
    base = rolled.where(F.col("pos") == 0).select("first", *[F.col(k).alias(f"_{k}") for k in LANES])
    rolled = rolled.join(base, "first")
    own = [(F.col(k) - F.col(f"_{k}")).bitwiseAND(low).alias(k) for k in LANES]
    with_turn = [(F.col(k) - F.col(f"_{k}") + F.col(f"_h{k}")).bitwiseAND(low).alias(k) for k in LANES]
    whole = rolled.where(F.col("pos") == F.col("turns") - 1).select("conv_id", "first", "turns", *with_turn)
    prefixes = rolled.where(F.col("pos") > 0).select(F.col("pos").alias("turns"), *own).distinct()
    return whole, prefixes


def maximal(numbered: DataFrame) -> DataFrame:
    """(conv_id, first, turns) of the conversations that are no proper prefix of another one; the least id of equal ones."""
    whole, prefixes = prefix_hashes(numbered)
    key = ["turns", *LANES]
    one = whole.groupBy(*key).agg(F.min_by(F.struct("conv_id", "first"), F.struct(F.col("conv_id").isNull(), "conv_id")).alias("_c"))
    return one.join(prefixes, key, "left_anti").select("_c.conv_id", "_c.first", "turns")


def render_turn(role: Column, text: Column) -> Column:
    """One turn between markers; markers inside a text are broken up. Null roles read ``unknown``, null texts are empty."""
    safe = lambda c, none: F.replace(F.coalesce(c, F.lit(none)), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), safe(role, "unknown"), F.lit("\n"), safe(text, ""), F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Rendered maximal conversations of ``turns`` (conv_id, turn, role, text): conv_id, segment, turns, text.

    Turns go by turn number, null last, ties by role and a hash of the text; repeated rows are turns of their own. Rows
    with a null conv_id are one conversation. A segment has at most ``segment_turns`` turns, and joining a conversation's
    segments gives its whole text. An empty table gives an empty one; other columns are ignored.
    """
    numbered = numbered_turns(turns)
    stay = maximal(numbered)
    rows = numbered.join(stay.withColumnRenamed("turns", "n"), numbered["conv_id"].eqNullSafe(stay["conv_id"])).drop(stay["conv_id"])
    place = F.col("at") - F.col("first")
    rows = rows.select("conv_id", F.floor(place / segment_turns).alias("segment"), "at", render_turn(F.col("role"), F.col("text")).alias("turn"))
    parts = rows.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("turns"), F.array_sort(F.collect_list(F.struct("at", "turn"))).alias("_t"))
    return parts.select("conv_id", "segment", "turns", F.array_join(F.transform("_t", lambda t: t["turn"]), "").alias("text"))
