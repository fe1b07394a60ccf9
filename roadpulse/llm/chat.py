"""Dialogues rendered once for every participant, with that speaker as the assistant.

Participants are the distinct roles of a conversation except those named as context (`system`).
The rendering is kept as one row per turn with its place in the whole, so a conversation of any
length is never gathered in one row; the rows of a perspective, in order of `turn_no`, concatenate
to the rendered dialogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONTEXT = ("system",)


def perspectives(turns: DataFrame, context: tuple[str, ...] = CONTEXT, block: int = 1024) -> DataFrame:
    """(conv_id, perspective, turn_no, turn, role, name, segment, segment_start, mask_start, mask_end)
    per participant and turn of `turns` (conv_id, turn, role, text).

    `role` is assistant for the perspective's own turns, the context role for context turns, and
    user for all others, whose speaker is given as `name`. `segment` is
    `<|role|>` or `<|user name=...|>`, a line feed, the text, `<|end|>` and a line feed. So that no text or
    name can pass for a mark, `<|` in a text is written `<||`, and `%` and `|` in a name `%25` and `%7C`.
    segment_start is its place in the rendered dialogue in code points; mask_start and mask_end bound
    the part the assistant is trained on: its text and end mark in its own turns, empty elsewhere.

    Turns are ordered by turn (nulls last), then role, text; repeated rows stay. A null role speaks as
    `unknown`, a null text is empty, and rows without a conv_id form one conversation of that name.
    Conversations with no participant give no rows. Running lengths are summed in blocks of `block`
    turn numbers, then over the blocks, so one conversation is not one task's work unless its turn
    numbers are all equal. Other columns are not looked at.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    speakers = rows.filter(~F.col("speaker").isin(*context)).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    seen = rows.alias("r").join(speakers.alias("s"), F.col("r.conv_id").eqNullSafe(F.col("s.conv_id"))).select("r.*", "perspective")
    own, ambient = F.col("speaker") == F.col("perspective"), F.col("speaker").isin(*context)
    role = F.when(own, "assistant").when(ambient, F.col("speaker")).otherwise("user")
    name = F.when(~own & ~ambient, F.col("speaker"))
    named = F.concat(F.lit(" name="), F.replace(F.replace(name, F.lit("%"), F.lit("%25")), F.lit("|"), F.lit("%7C")))
    head = F.concat(F.lit("<|"), role, F.coalesce(named, F.lit("")), F.lit("|>\n"))
    text = F.replace("text", F.lit("<|"), F.lit("<||"))
    shaped = seen.select("*", role.alias("role"), name.alias("name"), head.alias("head"), F.concat(head, text, F.lit("<|end|>\n")).alias("segment"))
    shaped = shaped.withColumn("length", F.length("segment")).withColumn("part", F.floor(F.coalesce("turn", F.lit((1 << 63) - 1)) / block))

    keys = ["conv_id", "perspective"]
    parts = shaped.groupBy(*keys, "part").agg(F.sum("length").alias("part_length"), F.count("*").alias("part_turns"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *keys, "part", F.coalesce(F.sum("part_length").over(before), F.lit(0)).alias("part_start"),
        F.coalesce(F.sum("part_turns").over(before), F.lit(0)).alias("part_no"),
    )
    order = Window.partitionBy(*keys, "part").orderBy(F.col("turn").asc_nulls_last(), "speaker", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = shaped.withColumn("upto", F.sum("length").over(upto)).withColumn("no", F.row_number().over(order)).alias("p")
    same = F.col("p.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("p.perspective") == F.col("s.perspective")) & (F.col("p.part") == F.col("s.part"))
    start = F.col("part_start") + F.col("upto") - F.col("length")
    mask = start + F.length("head")
    mine = F.col("p.role") == "assistant"
    return placed.join(starts.alias("s"), same).select(
        "p.conv_id", "p.perspective", (F.col("part_no") + F.col("no")).alias("turn_no"), "p.turn", "p.role", "p.name", "p.segment",
        start.alias("segment_start"), F.when(mine, mask).otherwise(start).alias("mask_start"),
        F.when(mine, start + F.col("length") - 1).otherwise(start).alias("mask_end"),
    )
