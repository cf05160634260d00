"""Chat formatting by perspective rotation: each participant in turn is the assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control signs of the rendered text.
START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    """Text in which no control sign can be read: a space follows ``<`` in ``<|``."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system: tuple[str, ...] = ("system",),
    turns_per_part: int = 256,
) -> DataFrame:
    """Every dialogue once per participant, who speaks as assistant; the others are named users.

    One row per conversation, perspective and part: ``n_turns``, ``n_rows``, ``text`` and
    ``mask``, the spans (code points, end exclusive) of the assistant's words and end signs,
    the only ones to learn from. System turns keep their role in every perspective and are no
    participants. A part holds ``turns_per_part`` consecutive turn numbers, so an ordinary
    dialogue is one part and an endless one is spread over many rows and tasks; parts follow
    each other in the text.

    Rows equal in conversation, turn, speaker and text are one turn and counted in ``n_rows``;
    others with the same turn number follow by speaker, then text. A null turn comes first, in
    a part of its own (null); a null conversation is one conversation; a null speaker is
    called ``unknown``; a null text is empty. A dialogue of system turns alone is rendered
    once, with a null perspective and an empty mask. An empty table has no rows. Only the
    named columns are read, so others may have any name.
    """
    lines = (
        turns.select(
            F.col(f"`{conversation}`").alias("conv"),
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{speaker}`"), F.lit("unknown")).alias("speaker"),
            escaped(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("body"),
        )
        .groupBy("conv", "turn", "speaker", "body")
        .agg(F.count("*").alias("times"))
    )
    is_system = F.col("speaker").isin(*system)
    people = (
        turns.select(
            F.col(f"`{conversation}`").alias("conv"),
            F.coalesce(F.col(f"`{speaker}`"), F.lit("unknown")).alias("speaker"),
        )
        .filter(~is_system)
        .distinct()
        .withColumnRenamed("speaker", "perspective")
    )
    part = F.floor(F.col("turn") / F.lit(turns_per_part)).cast("long")
    parts = (
        lines.withColumn("part", part)
        .groupBy("conv", "part")
        .agg(
            F.sort_array(F.collect_list(F.struct("turn", "speaker", "body"))).alias("lines"),
            F.count("*").alias("n_turns"),
            F.sum("times").alias("n_rows"),
        )
    )
    seen = parts.alias("p").join(
        people.alias("q"), F.col("p.conv").eqNullSafe(F.col("q.conv")), "left"
    )

    def segment(x: Column) -> Column:
        own = x["speaker"].eqNullSafe(F.col("perspective"))
        name = (
            F.when(own, F.lit("assistant"))
            .when(x["speaker"].isin(*system), F.lit("system"))
            .otherwise(F.concat(F.lit("user name="), F.regexp_replace(x["speaker"], r"[\s<|>]", "_")))
        )
        return F.struct(
            own.alias("own"),
            F.concat(F.lit(START), name, F.lit("\n")).alias("head"),
            F.concat(x["body"], F.lit(END)).alias("rest"),
        )

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["head"])
        end = begin + F.length(x["rest"])
        span = F.array(F.concat_ws(":", begin.cast("string"), end.cast("string")))
        none = F.array().cast("array<string>")
        return F.struct(
            (end + 1).alias("at"),
            F.concat(acc["mask"], F.when(x["own"], span).otherwise(none)).alias("mask"),
        )

    rendered = seen.select(
        F.col("p.conv").alias("conv"), "part", "perspective", "n_turns", "n_rows",
        F.transform("lines", segment).alias("segments"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("mask"))
    return rendered.select(
        F.col("conv").alias(conversation),
        "part",
        "perspective",
        "n_turns",
        "n_rows",
        F.array_join(F.transform("segments", lambda x: F.concat(x["head"], x["rest"], F.lit("\n"))), "").alias("text"),
        F.array_join(F.aggregate("segments", start, step, lambda acc: acc["mask"]), ",").alias("mask"),
    )
