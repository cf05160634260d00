"""DataFrame operators; keys and columns are always parameters."""

from .dedupe import distinct_rows, drop_null_keys, heal_by_key
from .flatten import explode_json_array
from .joins import dim_lookup, events_with_series, orphans, series_with_events
from .ranking import top_n
from .resample import fill_bins, resample_mean

__all__ = [
    "dim_lookup",
    "distinct_rows",
    "drop_null_keys",
    "events_with_series",
    "explode_json_array",
    "fill_bins",
    "heal_by_key",
    "orphans",
    "resample_mean",
    "series_with_events",
    "top_n",
]
