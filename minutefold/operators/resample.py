"""Time resampling: one mean per key and bin, with or without the empty bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import bin_index, bin_start, step_micros
from .dedupe import drop_null_keys

BIN = "__bin"
CHUNK = "__chunk"
FIRST = "__first"
LAST = "__last"
HERE = "__here"

# Bins per chunk: the bound on the rows sorted together and on the rows that one
# row unfolds into.
CHUNK_BINS = 1024
# Bins, filled ones included, that one task of a dense result makes.
TASK_BINS = 500_000


def resample_mean(
    df: DataFrame,
    keys: list[str],
    ts: str,
    measures: list[str],
    every: str = "1 minute",
    dense: bool = True,
    partitions: int | None = None,
    work_path: str | None = None,
) -> DataFrame:
    """Mean of every measure per key and bin; bins are left-closed, labelled left.

    Bins are counted from 1970-01-01 00:00, so a length that divides a day starts
    anew at each midnight.

    Rows without a key or a time are left out, nulls and NaNs are skipped inside
    the mean. ``dense`` adds a row of nulls for each empty bin between a key's first
    and last bin. The means are built with partial aggregation before any shuffle,
    so a key with most of the rows costs no more than its number of bins.

    A dense result needs each key's span next to its bins, which scans the input a
    second time for the key and time columns alone. Where bins are far fewer than
    rows, pass ``work_path``: the bins are written there once and read from there, and
    the number of partitions follows from the sum of the spans unless it is given. Without
    it a third scan of those columns gives that sum, and ``spark.sql.shuffle.partitions`` is the
    least number.
    """
    step = step_micros(every)
    kind = df.schema[ts].dataType
    live = drop_null_keys(df, [*keys, ts]).select(
        *keys, bin_index(F.col(ts), step).alias(BIN), *measures
    )
    bins = live.groupBy(*keys, BIN).agg(
        *[F.avg(_skip_nan(df, m)).alias(m) for m in measures]
    )
    if dense:
        if work_path:
            bins.write.mode("overwrite").parquet(work_path)
            bins = df.sparkSession.read.schema(bins.schema).parquet(work_path)
            partitions = partitions or tasks_for(bins, keys, BIN)
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = partitions or max(least, tasks_for(live, keys, BIN))
        bins = fill_bins(bins, keys, BIN, partitions)
    return bins.select(*keys, bin_start(F.col(BIN), step, kind).alias(ts), *measures)


def tasks_for(bins: DataFrame, keys: list[str], index: str) -> int:
    """Tasks that a dense result takes, by the number of its bins."""
    span = (F.max(index) - F.min(index) + 1).alias("span")
    total = bins.groupBy(*keys).agg(span).agg(F.sum("span")).first()[0] or 0
    return -(-total // TASK_BINS) or 1


def fill_bins(
    bins: DataFrame, keys: list[str], index: str, partitions: int | None = None
) -> DataFrame:
    """Add a row of nulls for every missing index between a key's first and last.

    ``bins`` holds one row per key and BIGINT index, neither of them null. The work unit is a chunk of
    consecutive indexes: bins and chunks are shuffled, never the rows that fill the
    gaps, and a key with a long span is spread over as many tasks as it has chunks.
    Inside a chunk each bin unfolds up to the next one, the first bin also back to
    the chunk's start; a chunk without bins unfolds as a whole.
    """
    spark = bins.sparkSession
    # A fixed number of partitions, since AQE would size them by the few rows that
    # go in and not by the many that come out.
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in bins.columns if c not in (*keys, index)]
    on = [*keys, CHUNK]

    start = F.col(CHUNK) * CHUNK_BINS
    spans = bins.groupBy(*keys).agg(F.min(index).alias(FIRST), F.max(index).alias(LAST))
    chunks = (
        spans.withColumn(
            CHUNK, F.explode(F.sequence(_chunk_of(F.col(FIRST)), _chunk_of(F.col(LAST))))
        )
        .select(
            *on,
            F.greatest(FIRST, start).alias(FIRST),
            F.least(LAST, start + (CHUNK_BINS - 1)).alias(LAST),
        )
        .repartition(n, *on)
    )
    placed = bins.withColumn(CHUNK, _chunk_of(F.col(index))).repartition(n, *on)

    in_chunk = W.partitionBy(*on).orderBy(index)
    opens = F.lag(index).over(in_chunk).isNull()
    following = F.lead(index).over(in_chunk)
    return (
        chunks.join(placed, on, "left")
        .select(
            *keys,
            index,
            *others,
            F.when(opens, F.col(FIRST)).otherwise(F.col(index)).alias(FIRST),
            F.coalesce(following - 1, F.col(LAST)).alias(LAST),
        )
        .select(*keys, index, *others, F.explode(F.sequence(FIRST, LAST)).alias(HERE))
        .select(
            *keys,
            F.col(HERE).alias(index),
            *[F.when(F.col(HERE) == F.col(index), F.col(c)).alias(c) for c in others],
        )
    )


def _skip_nan(df: DataFrame, measure: str) -> Column:
    """``avg`` skips nulls but not NaNs."""
    col = F.col(measure)
    if isinstance(df.schema[measure].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def _chunk_of(index: Column) -> Column:
    return F.call_function("div", index - F.pmod(index, F.lit(CHUNK_BINS)), F.lit(CHUNK_BINS))
