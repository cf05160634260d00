"""JSON array text to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_text import not_json, sealed_json


def explode_json_array(df: DataFrame, col: str, out: str, on_bad: str = "error") -> DataFrame:
    """One row per element of a JSON array held as text, the element as text.

    Null and empty arrays give no row. Text that is not a JSON array raises, or
    gives no row with ``on_bad="null"``.
    """
    if on_bad not in ("error", "null"):
        raise ValueError(f"on_bad is 'error' or 'null', not {on_bad!r}")
    mode = {"error": "FAILFAST", "null": "PERMISSIVE"}[on_bad]
    kind = "array<string>"
    bad = not_json(F.col(col), kind) if on_bad == "error" else F.lit(None).cast(kind)
    parsed = sealed_json(
        F.col(col), kind, lambda own: F.concat(F.lit('["'), own, F.lit('"]')), lambda last: F.get(last, F.lit(0)), mode, bad
    )
    kept = [F.explode(parsed).alias(out) if c == col else F.col(c) for c in df.columns]
    return df.select(*kept)
