"""The two business questions, over either wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import top_n

# What the questions mean by high risk and by success.
HIGH_RISK_DAMAGE = 10000
SUCCESS = "Successful"


def strongest_under_risk(
    wide: DataFrame, on_missions_only: bool = False, nulls: str = "last"
) -> DataFrame:
    """Hero with the highest mean energy output on high-risk missions."""
    risky = wide.where(F.col("structural_damage") > HIGH_RISK_DAMAGE)
    if on_missions_only:
        risky = risky.where(F.col("mission_id").isNotNull())
    means = risky.groupBy("hero_name").agg(F.avg("energy_output").alias("avg_energy_output"))
    return top_n(means, "avg_energy_output", ["hero_name"], nulls=nulls)


def most_reliable(wide: DataFrame, nulls: str = "last") -> DataFrame:
    """Hero with the most distinct successful missions, and their mean stress level."""
    won = wide.where(F.col("mission_outcome") == SUCCESS)
    counts = won.groupBy("hero_name").agg(
        F.count_distinct("mission_id").alias("successful_missions_count"),
        F.avg("stress_level").alias("avg_stress_level"),
    )
    return top_n(counts, "successful_missions_count", ["hero_name"], nulls=nulls)


def preview(wide: DataFrame, rows: int = 10) -> DataFrame:
    return wide.limit(rows)
