"""Readers, exports and the persisted tables of the layers."""

from .files import SourceError, read_csv, read_json, read_parquet
from .sinks import LoadMetrics, export_csv, export_json, export_parquet
from .runs import LeaseLost, RunInProgress, RunLog
from .tables import BatchTable, BucketTable, DayTable, PartTable, VersionedTable

__all__ = [
    "BatchTable",
    "BucketTable",
    "DayTable",
    "LeaseLost",
    "LoadMetrics",
    "PartTable",
    "RunInProgress",
    "RunLog",
    "SourceError",
    "VersionedTable",
    "export_csv",
    "export_json",
    "export_parquet",
    "read_csv",
    "read_json",
    "read_parquet",
]
