"""Increments: batches merged into tables that already hold earlier ones."""

from .arrivals import apply_arrivals
from .increments import above_mark, above_mark_per_key, replace_days, upsert

__all__ = ["above_mark", "above_mark_per_key", "apply_arrivals", "replace_days", "upsert"]
