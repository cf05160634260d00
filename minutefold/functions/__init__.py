"""Column functions: text, JSON, time and casts."""

from .casts import to_date, to_int
from .json_text import json_field, json_fields
from .text import blank_to_null, normalise_text
from .times import bin_index, bin_start, step_micros, to_utc_ntz, trunc_ntz

__all__ = [
    "bin_index",
    "bin_start",
    "blank_to_null",
    "json_field",
    "json_fields",
    "normalise_text",
    "step_micros",
    "to_date",
    "to_int",
    "to_utc_ntz",
    "trunc_ntz",
]
