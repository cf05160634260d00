"""What the operators of this subpackage share: intermediate tables, text units, names."""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager
from typing import ClassVar

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutefold.config import scratch_path
from minutefold.sources.tables import Folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: What a Python worker gets at a time. Whole texts are long rows: at Spark's default of
#: ten thousand a batch and its copies take more memory than a task's share of an executor.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans made inside send rows to Python in small batches; the settings go back after."""
    before = {key: spark.conf.get(key) for key in BATCHES}
    try:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class Scratch:
    """Tables in the cluster's shared folder; they survive the loss of an executor.

    ``land`` writes a frame and reads it back, which cuts its lineage and makes values that
    depend on the layout of a run (partition numbers) the same for every later reader.
    ``release`` and ``drop`` remove tables that nothing reads any more. What a lazy result
    still reads is removed when the program ends, if its session is alive then.
    """

    #: Every one that was opened, so that a caller can drop what a function has landed.
    opened: ClassVar[list[Scratch]] = []

    def __init__(self):
        self._tables: list[tuple[SparkSession, str, str]] = []
        Scratch.opened.append(self)

    def land(self, df: DataFrame, label: str) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, label)
        self._tables.append((spark, path, label))
        with small_batches(spark):
            df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def release(self, label: str, keep: int = 0) -> None:
        """Remove the tables of one label but the last ``keep``."""
        own = [t for t in self._tables if t[2] == label]
        for table in own[: len(own) - keep]:
            Folder(table[0], table[1]).drop()
            self._tables.remove(table)

    def drop(self) -> None:
        for spark, path, _ in self._tables:
            Folder(spark, path).drop()
        self._tables.clear()

    @classmethod
    def drop_opened(cls, since: int = 0) -> None:
        """Drop everything of those opened after the first ``since``."""
        for scratch in cls.opened[since:]:
            scratch.drop()
        del cls.opened[since:]


@atexit.register
def _at_exit() -> None:
    if SparkContext._active_spark_context is not None:
        Scratch.drop_opened()


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words as long; null and blank texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame less the columns that an operator is about to add, in any case of letters."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
