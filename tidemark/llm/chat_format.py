"""Multi-party dialogues, rendered once for every participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

PART_TURNS = 256
INSTRUCTIONS = "system"  # speaks to everybody and is nobody's perspective


def _numbered(turns: DataFrame) -> DataFrame:
    """The turns with ``position`` in their conversation from 0, however many turns one has.

    Turns are counted per conversation and slice of turn numbers, the slices of a conversation are summed up,
    and turns are ranked inside their slice. A slice holds ``PART_TURNS`` turn numbers; only turns that
    share their number, and so have no order of their own, may make it longer.
    """
    slice_of = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / PART_TURNS)
    turns = turns.withColumn("slice", slice_of)
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = turns.groupBy("conv_id", "slice").agg(F.count("*").alias("n")).select(
        "conv_id", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    inside = Window.partitionBy("conv_id", "slice").orderBy("turn", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & F.col("slice").eqNullSafe(F.col("of_slice"))
    offsets = slices.withColumnsRenamed({"conv_id": "of_conv", "slice": "of_slice"})
    return (
        turns.withColumn("rank", F.row_number().over(inside) - 1)
        .join(offsets, same)
        .select("conv_id", "role", "text", (F.col("rank") + F.col("earlier")).alias("position"))
    )


def segment(role: Column, speaker: Column, text: Column) -> tuple[Column, Column, Column]:
    """What is written before a turn's text, the text, and what is written after it.

    The speaker whose perspective it is writes as assistant, everybody else as a user with a name.
    """
    tag = (
        F.when(role == speaker, F.lit("assistant"))
        .when(role == INSTRUCTIONS, F.lit(INSTRUCTIONS))
        .otherwise(F.concat(F.lit("user name="), role))
    )
    return F.concat(F.lit("<|"), tag, F.lit("|>\n")), text, F.lit("<|end|>\n")


def rotate_perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Render every conversation once for each participant: conv_id, perspective, part, n_turns, text, mask.

    ``turns`` has conv_id, turn, role, text; participants are the roles but ``system``. A rendering is written
    in parts of ``part_turns`` turns (part 0, 1, ...), so that a conversation with a third of all turns is
    many rows, none of which holds it whole; its parts in order, joined, are the dialogue. ``mask`` lists the
    spans (begin-end in code points of the part's text, the end not included) that are learnt: the texts of
    the perspective's own turns with their end mark. A part without such turns has an empty mask.

    Turns go by number, those with equal numbers by role and text; NULL numbers come first. A NULL role is the
    role ``unknown``, a NULL text the empty one; rows that repeat are turns of their own; NULL conversations are
    one conversation. A conversation of the system alone has no participant and no rows. Empty table: no rows.
    """
    clean = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = written(_numbered(clean).withColumn("part", F.floor(F.col("position") / part_turns)), "turns")
    speakers = (
        rows.filter(F.col("role") != INSTRUCTIONS).select(F.col("conv_id").alias("of_conv"), F.col("role").alias("perspective")).distinct()
    )
    head, text, tail = segment(F.col("role"), F.col("perspective"), F.col("text"))
    own = F.col("role") == F.col("perspective")
    told = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv"))).select(
        "conv_id",
        "perspective",
        "part",
        "position",
        F.concat(head, text, tail).alias("piece"),
        F.length(head).alias("skip"),
        (F.length(text) + F.length(F.lit("<|end|>"))).alias("learnt"),
        own.alias("own"),
    )
    here = Window.partitionBy("conv_id", "perspective", "part").orderBy("position")
    begin = F.coalesce(F.sum(F.length("piece")).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("skip")
    placed = told.withColumn("begin", begin)
    span = F.when(F.col("own"), F.concat_ws("-", F.col("begin").cast("string"), (F.col("begin") + F.col("learnt")).cast("string")))
    ordered = F.array_sort(F.collect_list(F.struct("position", "piece", span.alias("span"))))  # part_turns at most
    return (
        placed.groupBy("conv_id", "perspective", "part")
        .agg(F.count("*").alias("n_turns"), ordered.alias("pieces"))
        .select(
            "conv_id",
            "perspective",
            "part",
            "n_turns",
            F.array_join("pieces.piece", "").alias("text"),
            F.array_join("pieces.span", ",").alias("mask"),
        )
    )


def render_chats(turns: DataFrame) -> DataFrame:
    """``rotate_perspectives`` over a table of conversations."""
    return rotate_perspectives(turns)
