"""Joins on time bins, dimension lookups and orphans.

No join carries a broadcast hint: Spark broadcasts a side whose size it has checked
against ``spark.sql.autoBroadcastJoinThreshold``, and sort-merges beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import bin_index, bin_start, step_micros
from .dedupe import drop_null_keys


def _binned(events: DataFrame, ts: str, every: str, name: str) -> DataFrame:
    step = step_micros(every)
    edge = bin_start(bin_index(F.col(ts), step), step, events.schema[ts].dataType)
    return events.withColumn(name, edge)


def series_with_events(
    series: DataFrame,
    events: DataFrame,
    keys: list[str],
    series_ts: str,
    event_ts: str,
    every: str = "1 minute",
) -> DataFrame:
    """Every series row, with the events of its key whose bin starts at its time.

    Equality on the bin, not an as-of match. A series row with several events comes
    out several times; one without any has nulls in the event columns.

    Events may crowd into one bin, and AQE cannot split the right side of a left join;
    so it is written as an inner join, where AQE splits either side, plus an anti join
    against the distinct keys of the events. Both read one shuffle of the series.
    """
    on = [*keys, series_ts]
    added = [c for c in events.columns if c not in (*keys, event_ts)]
    edges = [f"__on{i}" for i in range(len(on))]
    binned = _binned(drop_null_keys(events, [*keys, event_ts]), event_ts, every, edges[-1])
    right = binned.withColumnsRenamed(dict(zip(keys, edges, strict=False))).select(*edges, *added)
    out = [*series.columns, *added]

    # Null-safe equality: plain equality would filter nulls out of the series under
    # the inner join only, and the two joins could not share its shuffle. The right
    # side has no nulls, so the results are the same.
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(on, edges, strict=True)]
    matched = series.join(right, same, "inner").select(*out)
    unmatched = series.join(right.select(*edges).distinct(), same, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def events_with_series(
    events: DataFrame,
    series: DataFrame,
    keys: list[str],
    event_ts: str,
    series_ts: str,
    every: str = "1 minute",
) -> DataFrame:
    """Every event, with the series row of its key at the start of its bin, if any.

    The series is usually far larger, so it is cut down to the distinct bins that events
    touch before it is joined; where those are few, Spark does so while it scans. Crowded
    bins are on the left, which AQE can split. Bins filled in between carry nothing:
    a sparse series gives the same rows as a dense one.
    """
    on = [*keys, "__edge"]
    added = [c for c in series.columns if c not in (*keys, series_ts)]
    left = _binned(events, event_ts, every, "__edge")
    right = series.select(*keys, F.col(series_ts).alias("__edge"), *added)
    right = right.join(left.select(*on).distinct(), on, "left_semi")
    return left.join(right, on, "left").select(*events.columns, *added)


def dim_lookup(fact: DataFrame, dim: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Fact rows with the dimension's columns *and its key* instead of their own key.

    A fact row without a match therefore has a null key in the result.
    """
    found = dim.select(F.col(key).alias("__dim_key"), *cols)
    joined = fact.join(found, F.col(key) == F.col("__dim_key"), "left")
    return joined.drop(key).withColumnRenamed("__dim_key", key)


def orphans(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    known = parent.select(F.col(parent_col).alias("__parent")).distinct()
    return child.where(F.col(col).isNotNull()).join(
        known, F.col(col) == F.col("__parent"), "left_anti"
    )
