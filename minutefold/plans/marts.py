"""Batches of the star schema: hero dimension, mission bridge, biometrics fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import to_date, to_int
from ..streaming.increments import above_mark, above_mark_per_key, upsert
from .schemas import DAMAGES, MEASURES

BRIDGE_KEYS = ["mission_id", "hero_id"]


def dim_heroes(staged: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Heroes of the batch over the heroes known so far."""
    first = to_date(F.col("first_appearance")).alias("first_appearance")
    batch = staged.select("hero_id", "name", "alter_ego", first)
    return upsert(target, batch, ["hero_id"])


def dim_missions_heroes(staged: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Mission and hero rows of the batch over those known so far."""
    batch = staged.select(
        *BRIDGE_KEYS,
        "location",
        "timestamp",
        "outcome",
        *[to_int(F.col(d)).alias(d) for d in DAMAGES],
    )
    return upsert(target, batch, BRIDGE_KEYS)


def fact_biometrics(
    staged: DataFrame, mark=None, target: DataFrame | None = None, per_key: bool = False
) -> DataFrame:
    """Rows to append: those after the mark, or after each hero's own last row."""
    rows = staged.select("timestamp", "hero_id", *MEASURES)
    if per_key and target is not None:
        return above_mark_per_key(rows, target, ["hero_id"], "timestamp")
    return above_mark(rows, "timestamp", mark)
