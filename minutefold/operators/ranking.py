"""Top rows with the place of nulls spelled out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: str, tie: list[str], n: int = 1, nulls: str = "last") -> DataFrame:
    """The ``n`` rows greatest in ``by``; nulls rank ``first`` or ``last``."""
    if nulls not in ("first", "last"):
        raise ValueError(f"nulls are 'first' or 'last', not {nulls!r}")
    order = F.col(by).desc_nulls_first() if nulls == "first" else F.col(by).desc_nulls_last()
    return df.orderBy(order, *[F.col(t).asc_nulls_last() for t in tie]).limit(n)
