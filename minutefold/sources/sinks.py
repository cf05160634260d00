"""File exports and load metrics."""

from __future__ import annotations

import time

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header row; quotes inside values are doubled, spaces around them kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines; a null field is written as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def export_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


class LoadMetrics:
    """Row and null counts gathered while a load runs, without a job of their own.

    ``watch`` wraps a frame on its way into a write; the numbers are there once the
    write is done.
    """

    def __init__(self, name: str):
        self.name = name
        self.started = time.monotonic()
        self.watched: dict[str, tuple[Observation, DataFrame, list[Column]]] = {}

    def watch(self, df: DataFrame, label: str, null_keys: list[str] = ()) -> DataFrame:
        seen = Observation(f"{self.name}.{label}")
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_keys]
        metrics = [F.count(F.lit(1)).alias("rows"), *nulls]
        self.watched[label] = (seen, df, metrics)
        return df.observe(seen, *metrics)

    def summary(self) -> dict[str, object]:
        counts = {}
        for label, (seen, df, metrics) in self.watched.items():
            found = _observed(seen) or df.agg(*metrics).first().asDict()
            counts |= {f"{label}.{metric}": value for metric, value in found.items()}
        return {"load": self.name, "seconds": time.monotonic() - self.started, **counts}


def _observed(seen: Observation) -> dict[str, object] | None:
    """The metrics, or None where AQE found the result empty and dropped the plan.

    The caller then counts with a job of its own.
    """
    try:
        return seen.get
    except Py4JError:
        return None
