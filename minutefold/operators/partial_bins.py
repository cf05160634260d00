"""Bins as sums and counts, so that rows which come later can still be added to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import bin_index, step_micros
from .dedupe import drop_null_keys
from .resample import BIN, _skip_nan, fill_bins, tasks_for

# Time of a bin's last reading, in microseconds.
LATEST = "__latest"
KNOWN = "__known"
STARTS = "__starts"


def _sum(measure: str) -> str:
    return f"{measure}__sum"


def _count(measure: str) -> str:
    return f"{measure}__n"


def bin_parts(df: DataFrame, keys: list[str], ts: str, measures: list[str], every: str) -> DataFrame:
    """Every row as a part of its bin. Rows without a key or a time are left out, nulls and NaNs
    count for nothing; see ``resample_mean``."""
    values = {m: _skip_nan(df, m).cast("double") for m in measures}
    return drop_null_keys(df, [*keys, ts]).select(
        *keys,
        bin_index(F.col(ts), step_micros(every)).alias(BIN),
        F.unix_micros(F.col(ts).cast("timestamp")).alias(LATEST),
        *[v.alias(_sum(m)) for m, v in values.items()],
        *[v.isNotNull().cast("bigint").alias(_count(m)) for m, v in values.items()],
    )


def merge_parts(parts: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row per key and bin. Parts are added up before the shuffle."""
    added = [c for m in measures for c in (_sum(m), _count(m))]
    return parts.groupBy(*keys, BIN).agg(
        F.max(LATEST).alias(LATEST), *[F.sum(c).alias(c) for c in added]
    )


def means_after(
    merged: DataFrame,
    last: DataFrame | None,
    keys: list[str],
    measures: list[str],
    partitions: int | None = None,
) -> DataFrame:
    """Means of the merged bins after each key's last one, and nulls for the bins in between.

    ``last`` has the keys and the index of the last bin known, one row per key; a key it lacks
    starts at its first bin here. So bins that are given in several turns, each turn later than
    the one before, are together those of one dense resample.
    """
    means = [_mean(m).alias(m) for m in measures]
    if last is None:
        bins = merged.select(*keys, BIN, *means, F.lit(False).alias(STARTS))
    else:
        found = merged.join(last.select(*keys, F.col(BIN).alias(KNOWN)), keys, "left")
        later = found.where(F.col(KNOWN).isNull() | (F.col(BIN) > F.col(KNOWN)))
        bins = later.select(*keys, BIN, *means, F.lit(False).alias(STARTS))
        # The last bin known stands for the start of the gap, and goes again below.
        gaps = later.where(F.col(KNOWN).isNotNull()).groupBy(*keys).agg(F.max(KNOWN).alias(BIN))
        nothing = [F.lit(None).cast("double").alias(m) for m in measures]
        bins = bins.unionByName(gaps.select(*keys, BIN, *nothing, F.lit(True).alias(STARTS)))
    filled = fill_bins(bins, keys, BIN, partitions or tasks_for(bins, keys, BIN))
    return filled.where(~F.coalesce(STARTS, F.lit(False))).drop(STARTS)


def _mean(measure: str) -> Column:
    return F.when(F.col(_count(measure)) > 0, F.col(_sum(measure)) / F.col(_count(measure)))
