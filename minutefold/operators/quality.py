"""Data-quality checks: failing rows, counts per check, and a severity policy."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import orphans


class QualityError(RuntimeError):
    """Checks of severity ``error`` that failed."""


def is_missing(col: str) -> Column:
    return F.col(col).isNull()


def is_outside(col: str, lo=None, hi=None) -> Column:
    """Below ``lo`` or above ``hi``; a bound left out does not count. Nulls pass."""
    tests = []
    if lo is not None:
        tests.append(F.col(col) < F.lit(lo))
    if hi is not None:
        tests.append(F.col(col) > F.lit(hi))
    if not tests:
        raise ValueError("give at least one bound")
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def is_not_in(col: str, values: list) -> Column:
    """Not one of the values. Nulls pass."""
    return F.coalesce(~F.col(col).isin(*values), F.lit(False))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(is_missing(col))


def between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    return df.where(is_outside(col, lo, hi))


def in_set(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(is_not_in(col, values))


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per value of the columns that occurs more than once, with its count.

    Rows in which all of the columns are null are ignored.
    """
    present = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    counted = df.where(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)


def in_parent(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    return orphans(df, col, parent, parent_col)


@dataclass(frozen=True)
class Check:
    """One check on one model of a set; ``test`` names the function above."""

    model: str
    test: str
    columns: tuple[str, ...]
    args: dict = field(default_factory=dict)
    severity: str = "warn"


ROW_TESTS = {"not_null": is_missing, "between": is_outside, "in_set": is_not_in}


def report(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: model, test, column, failures, status.

    All row-level checks of a model share one pass over it. Uniqueness counts the
    values that repeat; ``in_parent`` counts child rows, grouped by their reference
    before the join so that one frequent value is a single row in it.
    """
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        mine = [c for c in checks if c.model == model]
        on_rows = [c for c in mine if c.test in ROW_TESTS]
        if on_rows:
            parts.append(_count_rows(models[model], on_rows))
        for check in mine:
            if check.test == "unique":
                failing = unique(models[model], list(check.columns))
                parts.append(_one(failing.agg(F.count(F.lit(1)).alias("failures")), check))
            elif check.test == "in_parent":
                parts.append(_one(_count_orphans(models, check), check))
            elif check.test not in ROW_TESTS:
                raise ValueError(f"no such test: {check.test!r}")
    return reduce(DataFrame.unionByName, parts)


def enforce(results: DataFrame) -> list[dict]:
    """Run the report, return its rows, and raise if a check of severity error failed."""
    return raise_failed([r.asDict() for r in results.collect()])  # one row per check


def counted(check: Check, failures: int) -> dict:
    """A row of a report from a count that was kept."""
    status = "pass" if failures == 0 else check.severity
    return {"model": check.model, "test": check.test, "column": ",".join(check.columns), "failures": failures, "status": status}


def raise_failed(rows: list[dict]) -> list[dict]:
    """The rows of a report, unless a check of severity error failed."""
    failed = [r for r in rows if r["status"] == "error"]
    if failed:
        text = "; ".join(
            f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failed
        )
        raise QualityError(text)
    return rows


def _labels(check: Check) -> list[Column]:
    return [F.lit(check.model), F.lit(check.test), F.lit(",".join(check.columns))]


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(severity)


def _one(counted: DataFrame, check: Check) -> DataFrame:
    model, test, column = _labels(check)
    return counted.select(
        model.alias("model"),
        test.alias("test"),
        column.alias("column"),
        F.col("failures"),
        _status(F.col("failures"), F.lit(check.severity)).alias("status"),
    )


def _count_rows(df: DataFrame, checks: list[Check]) -> DataFrame:
    counts = df.agg(
        *[
            F.count_if(ROW_TESTS[c.test](c.columns[0], **c.args)).alias(f"f{i}")
            for i, c in enumerate(checks)
        ]
    )
    cells = []
    for i, c in enumerate(checks):
        cells += [*_labels(c), F.col(f"f{i}"), F.lit(c.severity)]
    rows = counts.select(
        F.stack(F.lit(len(checks)), *cells).alias(
            "model", "test", "column", "failures", "severity"
        )
    )
    return rows.select(
        "model",
        "test",
        "column",
        "failures",
        _status(F.col("failures"), F.col("severity")).alias("status"),
    )


def _count_orphans(models: dict[str, DataFrame], check: Check) -> DataFrame:
    col = check.columns[0]
    references = models[check.model].groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    return lost_rows(references, check, models[check.args["parent"]])


def lost_rows(references: DataFrame, check: Check, parent: DataFrame) -> DataFrame:
    """``failures`` of an ``in_parent`` check, from the number of rows per reference, ``n_rows``."""
    lost = orphans(references, check.columns[0], parent, check.args["parent_col"])
    return lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures"))
