"""Checks: what fails, what nulls do, the report and the severity policy."""

import pytest
from fixture_files import rows

from minutefold.operators import quality
from minutefold.operators.quality import Check, QualityError, enforce, report
from minutefold.plans.checks import CHECKS, with_severity


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(
        [("a", 1, 5.0), ("a", 1, -1.0), ("a", None, None), ("a", None, 11.0), (None, None, 10.0),
         (None, None, 0.0), ("b", 2, float("nan"))],
        "k string, j int, v double",
    )


def test_unique(data):
    assert rows(quality.unique(data, ["k"])) == [("a", 4)]
    # Rows without any key are left out; rows with a part of it count.
    assert rows(quality.unique(data, ["k", "j"]), "j") == [("a", None, 2), ("a", 1, 2)]


def test_nulls_pass_all_but_not_null(data):
    assert quality.not_null(data, "k").count() == 2
    assert [r.v for r in quality.between(data, "v", 0, 10).orderBy("v").collect()][:2] == [-1.0, 11.0]
    assert quality.between(data, "v", lo=0).count() == 1
    assert quality.between(data, "v", hi=10).count() == 2  # NaN is above every number
    assert [r.k for r in quality.in_set(data, "k", ["a"]).collect()] == ["b"]
    with pytest.raises(ValueError, match="bound"):
        quality.between(data, "v")


def test_report_equals_failing_rows(spark, data):
    parent = spark.createDataFrame([("a",)], "p string")
    checks = [
        Check("data", "not_null", ("k",)),
        Check("data", "between", ("v",), {"lo": 0, "hi": 10}),
        Check("data", "in_set", ("k",), {"values": ["a", "b"]}),
        Check("data", "unique", ("k", "j")),
        Check("data", "in_parent", ("k",), {"parent": "parent", "parent_col": "p"}, "error"),
    ]
    found = report({"data": data, "parent": parent}, checks)
    assert {r.test: (r.column, r.failures, r.status) for r in found.collect()} == {
        "not_null": ("k", 2, "warn"),
        "between": ("v", 3, "warn"),
        "in_set": ("k", 0, "pass"),
        "unique": ("k,j", 2, "warn"),
        "in_parent": ("k", 1, "error"),
    }
    assert quality.in_parent(data, "k", parent, "p").count() == 1
    with pytest.raises(QualityError, match="data.k in_parent: 1"):
        enforce(found)
    assert len(enforce(found.where("test <> 'in_parent'"))) == 4


def test_report_on_an_empty_model(data):
    checks = [Check("data", "not_null", ("k",)), Check("data", "unique", ("k",))]
    found = report({"data": data.where("false")}, checks)
    assert {(r.test, r.failures, r.status) for r in found.collect()} == {
        ("not_null", 0, "pass"),
        ("unique", 0, "pass"),
    }


def test_unknown_test(data):
    with pytest.raises(ValueError, match="no such test"):
        report({"data": data}, [Check("data", "fuzzy", ("k",))])


def test_declared_checks():
    assert len(CHECKS) == 18
    assert {c.severity for c in CHECKS} == {"warn"}
    assert {c.severity for c in with_severity("error")} == {"error"}
