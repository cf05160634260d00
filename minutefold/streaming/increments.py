"""Keyed upsert, high-water mark and whole-day replacement, on frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import upsert_rows


def upsert(target: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key the batch lacks, plus the whole batch.

    The first run, without a target, is the batch itself. Batch rows with equal keys
    are all kept; null keys match nothing. Only the distinct keys of the batch meet
    the target: broadcast when small, shuffled once when not.
    """
    if target is None:
        return batch
    return upsert_rows(target, batch, keys)


def above_mark(batch: DataFrame, ts: str, mark: Column | object | None) -> DataFrame:
    """Batch rows later than the mark; all rows when there is no mark yet.

    ``mark`` is a value, which reaches the scan as a pushed filter, or a scalar
    subquery such as ``target.agg(F.max(ts)).scalar()``. Rows at or before the mark
    are late and left out.
    """
    if mark is None:
        return batch
    later = F.col(ts) > (mark if isinstance(mark, Column) else F.lit(mark))
    if isinstance(mark, Column):
        later = later | mark.isNull()
    return batch.where(later)


def above_mark_per_key(
    batch: DataFrame, target: DataFrame, keys: list[str], ts: str
) -> DataFrame:
    """Batch rows later than the target's last row of the same key."""
    marks = target.groupBy(*keys).agg(F.max(ts).alias("__mark"))
    return (
        batch.join(marks, keys, "left")
        .where(F.col("__mark").isNull() | (F.col(ts) > F.col("__mark")))
        .select(*batch.columns)
    )


def replace_days(target: DataFrame, batch: DataFrame, day: str) -> DataFrame:
    """Target with the days that the batch holds, from its last day on, taken from the batch.

    The batch holds full days; its earlier days are ignored, and days it lacks stay as
    they are, as do rows without a day. On a ``DayTable`` the same is a write of
    ``days_from(batch, day, mark)``.
    """
    fresh = days_from(batch, day, target.agg(F.max(day)).scalar())
    held = fresh.select(day).distinct()
    return target.join(held, day, "left_anti").select(*target.columns).unionByName(fresh)


def days_from(df: DataFrame, day: str, mark: Column | object | None) -> DataFrame:
    """Rows of the mark's day and later; all rows when there is no mark yet."""
    if mark is None:
        return df
    since = F.col(day) >= (mark if isinstance(mark, Column) else F.lit(mark))
    if isinstance(mark, Column):
        since = since | mark.isNull()
    return df.where(since)
