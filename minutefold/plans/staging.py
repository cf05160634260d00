"""Raw rows made trustworthy: typed, flattened, healed. Lazy views over the raw layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json_fields, normalise_text, to_utc_ntz
from ..operators import distinct_rows, drop_null_keys, explode_json_array, heal_by_key
from ..operators.resample import resample_mean
from .schemas import DAMAGES, MEASURES


def raw_biometrics(
    readings: DataFrame,
    every: str = "1 minute",
    partitions: int | None = None,
    work_path: str | None = None,
) -> DataFrame:
    """Readings as they land: one dense row of means per hero and bin."""
    return resample_mean(
        readings, ["hero_id"], "timestamp", MEASURES, every,
        partitions=partitions, work_path=work_path,
    )


def stg_heroes(raw: DataFrame, collation: str | None = None) -> DataFrame:
    """One row per hero, the name reduced to letters and digits; see ``heal_by_key``."""
    named = drop_null_keys(raw, ["hero_id"]).withColumn("name", normalise_text(F.col("name")))
    return heal_by_key(named, ["hero_id"], ["name", "alter_ego", "first_appearance"], collation)


def stg_missions(raw: DataFrame, on_bad: str = "error") -> DataFrame:
    """Distinct rows of mission and hero, times in UTC, damages still text.

    Distinct comes after the flattening and the time conversion, so one instant
    logged under two offsets is one row.
    """
    # Everything that is per mission is parsed before the rows multiply.
    parsed = drop_null_keys(raw, ["mission_id"]).select(
        "mission_id",
        "hero_ids",
        "location",
        to_utc_ntz(F.col("timestamp")).alias("timestamp"),
        "outcome",
        json_fields(F.col("damage_report"), DAMAGES).alias("damages"),
    )
    per_hero = explode_json_array(parsed, "hero_ids", "hero_id", on_bad)
    damages = [F.col(f"damages.{d}").alias(d) for d in DAMAGES]
    return distinct_rows(per_hero.select("*", *damages).drop("damages"))


def last_batch(batches: list[DataFrame]) -> DataFrame:
    """One row per hero and bin: that of the last batch, of those in order, that holds it.

    A batch has a bin once, and neither hero nor time is null. A batch is joined with the bins of
    the later ones, so the last is not shuffled. Both sides are large, however well their files
    compress: they are merged, not broadcast.
    """
    on = ["hero_id", "timestamp"]
    kept = batches[-1:]
    for n, batch in list(enumerate(batches))[-2::-1]:
        later = reduce(DataFrame.unionByName, [b.select(*on) for b in batches[n + 1 :]])
        kept.append(batch.join(later.hint("merge"), on, "left_anti"))
    return reduce(DataFrame.unionByName, kept)


def stg_biometrics(raw: DataFrame) -> DataFrame:
    """Bins with a hero and a time, the time as a UTC wall clock."""
    return drop_null_keys(raw, ["hero_id", "timestamp"]).select(
        to_utc_ntz(F.col("timestamp"), instant=True).alias("timestamp"), "hero_id", *MEASURES
    )
