"""Not-null filters, row distinct and heal-by-key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in which every key is present.

    Spelled out, and not ``dropna``: that neither reaches the scan nor keeps NaN.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def distinct_rows(df: DataFrame) -> DataFrame:
    """One copy of each row; copies collapse before the shuffle."""
    return df.distinct()


def heal_by_key(df: DataFrame, keys: list[str], cols: list[str], collation: str | None = None) -> DataFrame:
    """One row per key with the greatest value of each column on its own.

    Nulls are skipped, so a value missing in one duplicate is healed from another;
    the columns of a result row may come from different input rows. Text is compared by
    its bytes, or in the order of a collation such as ``UNICODE`` or ``de``.
    """

    def greatest(c: str) -> Column:
        if not collation or not isinstance(df.schema[c].dataType, T.StringType):
            return F.max(c)
        return F.max(F.collate(F.col(c), collation)).cast("string")

    return df.groupBy(*keys).agg(*[greatest(c).alias(c) for c in cols])
