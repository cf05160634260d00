"""Casts of text columns."""

from __future__ import annotations

from pyspark.sql import Column


def to_int(col: Column, strict: bool = True) -> Column:
    """Text to integer; text such as ``1000.5`` raises, or is null when not strict."""
    return col.cast("int") if strict else col.try_cast("int")


def to_date(col: Column, strict: bool = True) -> Column:
    """Text or timestamp to date; other text raises, or is null when not strict."""
    return col.cast("date") if strict else col.try_cast("date")
