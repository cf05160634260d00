"""Operators on small inputs: nulls, ties, gaps, copies and hot groups."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from fixture_files import rows
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from minutefold.functions import json_field, json_fields, normalise_text, step_micros
from minutefold.functions import to_int, to_utc_ntz, trunc_ntz
from minutefold.operators import (
    dim_lookup,
    distinct_rows,
    drop_null_keys,
    events_with_series,
    explode_json_array,
    heal_by_key,
    orphans,
    resample_mean,
    series_with_events,
    top_n,
)
from minutefold.operators.resample import CHUNK_BINS, fill_bins

# A failing task surfaces as either.
FAILS = (PySparkException, Py4JError)


# --- Resampling ------------------------------------------------------------------


def readings(seed, start="2025-01-01", span_minutes=3 * CHUNK_BINS, n=400):
    rng = np.random.default_rng(seed)
    at = pd.Timestamp(start) + pd.to_timedelta(rng.integers(0, span_minutes * 60, n), unit="s")
    pdf = pd.DataFrame({"key": rng.choice(["a", "b", "c", None], n), "ts": at})
    pdf["whole"] = rng.integers(0, 100, n)
    pdf["gappy"] = np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 100, n))
    return pdf


def by_pandas(pdf, every):
    out = pdf.set_index("ts").groupby("key").resample(every)[["whole", "gappy"]].mean()
    return out.reset_index()[["key", "ts", "whole", "gappy"]]


def as_pandas(df):
    out = df.select("key", "ts", "whole", "gappy").toPandas()
    out["ts"] = out["ts"].astype("datetime64[ns]")
    return out.sort_values(["key", "ts"]).reset_index(drop=True)


@pytest.mark.parametrize(
    ("seed", "start", "every", "in_pandas"),
    [
        (1, "2025-01-01", "1 minute", "1min"),
        (2, "1969-12-30 23:59:30", "1 minute", "1min"),
        (3, "2025-01-01", "15 minutes", "15min"),
        (4, "2024-02-28", "1 day", "1D"),
    ],
)
def test_dense_resample_equals_pandas(spark, seed, start, every, in_pandas):
    pdf = readings(seed, start)
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = as_pandas(resample_mean(df, ["key"], "ts", ["whole", "gappy"], every))
    want = by_pandas(pdf, in_pandas)
    want["ts"] = want["ts"].astype("datetime64[ns]")
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_resample_through_a_table(spark, folder):
    df = spark.createDataFrame(readings(5)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    args = (df, ["key"], "ts", ["whole", "gappy"])
    at_once, in_steps = resample_mean(*args), resample_mean(*args, work_path=f"{folder}/bins")
    pd.testing.assert_frame_equal(as_pandas(at_once), as_pandas(in_steps))


def test_resample_sparse_keeps_only_filled_bins(spark):
    df = spark.createDataFrame(readings(6))
    dense = resample_mean(df, ["key"], "ts", ["whole"])
    sparse = resample_mean(df, ["key"], "ts", ["whole"], dense=False)
    assert rows(sparse, "key", "ts") == rows(dense.where("whole is not null"), "key", "ts")
    assert sparse.schema["ts"].dataType == df.schema["ts"].dataType


def test_resample_keeps_one_row_per_bin_for_a_hot_key(spark):
    """One key with most of the rows, one with a single row, one with a long empty span."""
    t0 = datetime(2025, 1, 1)
    hot = [("hot", t0 + timedelta(seconds=i % 600), float(i % 7)) for i in range(20000)]
    lone = [("lone", t0, 1.0)]
    wide = [("wide", t0, 1.0), ("wide", t0 + timedelta(minutes=5 * CHUNK_BINS), 2.0)]
    df = spark.createDataFrame(hot + lone + wide, "key string, ts timestamp_ntz, v double")
    counts = resample_mean(df, ["key"], "ts", ["v"]).groupBy("key").agg(
        F.count(F.lit(1)), F.count("v"), F.count_distinct("ts")
    )
    n = 5 * CHUNK_BINS + 1
    assert rows(counts, "key") == [("hot", 10, 10, 10), ("lone", 1, 1, 1), ("wide", n, 2, n)]


def test_resample_by_two_keys(spark):
    t0 = datetime(2025, 1, 1)
    data = [("a", 1, t0, 1), ("a", 1, t0 + timedelta(minutes=2), 3), ("a", 2, t0, 5)]
    df = spark.createDataFrame(data, "k string, j int, ts timestamp_ntz, v int")
    got = resample_mean(df, ["k", "j"], "ts", ["v"])
    assert rows(got, "k", "j", "ts") == [
        ("a", 1, t0, 1.0),
        ("a", 1, t0 + timedelta(minutes=1), None),
        ("a", 1, t0 + timedelta(minutes=2), 3.0),
        ("a", 2, t0, 5.0),
    ]


def test_nothing_in_nothing_out(spark):
    df = spark.createDataFrame([], "key string, ts timestamp_ntz, v double")
    assert resample_mean(df, ["key"], "ts", ["v"]).count() == 0


def test_fill_bins_at_chunk_edges(spark):
    edges = [CHUNK_BINS - 1, CHUNK_BINS, 2 * CHUNK_BINS - 1, 4 * CHUNK_BINS, -1]
    df = spark.createDataFrame([("k", i, i) for i in edges], "k string, i bigint, v bigint")
    got = rows(fill_bins(df, ["k"], "i"), "i")
    assert [r[1] for r in got] == list(range(-1, 4 * CHUNK_BINS + 1))
    assert [r[2] for r in got if r[2] is not None] == sorted(edges)


def test_step_needs_a_length():
    assert step_micros("2 hours") == 7_200_000_000
    with pytest.raises(ValueError, match="positive"):
        step_micros("0 minutes")


# --- Text, JSON, time, casts ------------------------------------------------------------


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [("Mr. Paper-Weight", "mrpaperweight"), ("Ö'Konom_1 é", "ökonom1é"), ("***", ""), (None, None)],
)
def test_normalise_text(spark, text, want):
    assert one(spark, text, normalise_text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"a": 1, "b": null}', ("1", None)),
        ('{"a": "x", "a": "y"}', ("y", None)),
        ("[1]", (None, None)),
        ("null", (None, None)),
        (None, None),
    ],
)
def test_json_fields(spark, text, want):
    got = one(spark, text, lambda c: json_fields(c, ["a", "b"]))
    assert (None if got is None else tuple(got)) == want


@pytest.mark.parametrize("text", ["junk", '{"a": 1', ""])
def test_json_fields_raise_on_text_that_is_not_json(spark, text):
    with pytest.raises(FAILS):
        one(spark, text, lambda c: json_fields(c, ["a"]))


def test_json_field_is_lenient(spark):
    assert one(spark, '{"a": {"b": 1}}', lambda c: json_field(c, "a")) == '{"b":1}'
    assert one(spark, "junk", lambda c: json_field(c, "a")) is None


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-12-31T19:03:00-05:00", datetime(2025, 1, 1, 0, 3)),
        ("2025-01-01T00:03:00+00:00", datetime(2025, 1, 1, 0, 3)),
        ("2025-01-01 00:03:00", datetime(2025, 1, 1, 0, 3)),
        (None, None),
    ],
)
def test_to_utc(spark, text, want):
    assert one(spark, text, to_utc_ntz) == want


def test_trunc_stays_without_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-01-01 00:01:59.5' AS t")
    got = df.select(trunc_ntz(F.col("t"), "minute").alias("m"))
    assert got.dtypes == [("m", "timestamp_ntz")]
    assert got.first()[0] == datetime(2025, 1, 1, 0, 1)


def test_to_int(spark):
    assert one(spark, " 12 ", to_int) == 12
    assert one(spark, "1000.5", lambda c: to_int(c, strict=False)) is None
    with pytest.raises(FAILS):
        one(spark, "1000.5", to_int)


# --- Dedupe and flatten ----------------------------------------------------------------


def test_heal_takes_each_column_on_its_own(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("a", "m", None), ("a", "k", "w"), (None, "n", "z")],
        "k string, u string, v string",
    )
    healed = heal_by_key(drop_null_keys(df, ["k"]), ["k"], ["u", "v"])
    assert rows(healed) == [("a", "m", "x")]


def test_distinct_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert distinct_rows(df).count() == 2


def test_explode_json_array(spark):
    data = [(1, '["a","b"]'), (2, "[]"), (3, None), (4, '[1,{"k":2},null]')]
    df = spark.createDataFrame(data, "id int, c string")
    assert rows(explode_json_array(df, "c", "e"), "id", "e") == [
        (1, "a"), (1, "b"), (4, None), (4, "1"), (4, '{"k":2}'),
    ]


@pytest.mark.parametrize("bad", ['{"a":1}', '["a"', "null", "", "  ", '"a"'])
def test_explode_raises_on_what_is_not_an_array(spark, bad):
    df = spark.createDataFrame([(1, '["a"]'), (2, bad)], "id int, c string")
    with pytest.raises(FAILS):
        explode_json_array(df, "c", "e").collect()
    assert rows(explode_json_array(df, "c", "e", on_bad="null")) == [(1, "a")]


# --- Joins ------------------------------------------------------------------------------


MINUTE = datetime(2025, 1, 1, 0, 1)


def series_and_events(spark, crowd=1):
    series = spark.createDataFrame(
        [("a", MINUTE, 1.0), ("a", MINUTE + timedelta(minutes=1), 2.0), ("b", MINUTE, 3.0),
         (None, MINUTE, 4.0), ("c", None, 5.0)],
        "key string, ts timestamp_ntz, v double",
    )
    at = MINUTE + timedelta(seconds=30)
    events = [("a", at, i % 3) for i in range(crowd)]
    events += [("z", at, 7), (None, at, 8), ("b", at + timedelta(minutes=1), 9), ("c", None, 10)]
    return series, spark.createDataFrame(events, "key string, at timestamp_ntz, e int")


@pytest.mark.parametrize("crowd", [1, 500])
def test_series_with_events(spark, crowd):
    """Each series row stays; the crowded bin fans out, copies of events included."""
    series, events = series_and_events(spark, crowd)
    got = series_with_events(series, events, ["key"], "ts", "at")
    assert got.columns == ["key", "ts", "v", "e"]
    want = [("a", MINUTE, 1.0, i % 3) for i in range(crowd)] + [
        ("a", MINUTE + timedelta(minutes=1), 2.0, None),
        ("b", MINUTE, 3.0, None),
        (None, MINUTE, 4.0, None),
        ("c", None, 5.0, None),
    ]
    assert sorted(map(repr, rows(got))) == sorted(map(repr, want))


def test_spread_plan_has_no_left_outer_join(spark):
    """The plan for crowded bins: an inner and an anti join over one shuffle of the series."""
    series, events = series_and_events(spark)
    settings = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = series_with_events(series, events, ["key"], "ts", "at")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in settings.items():
            spark.conf.set(k, v)
    assert "LeftOuter" not in plan
    assert "LeftAnti" in plan and "Inner" in plan and "ReusedExchange" in plan


def test_events_with_series(spark):
    series, events = series_and_events(spark)
    got = events_with_series(events, series, ["key"], "at", "ts")
    assert got.columns == ["key", "at", "e", "v"]
    found = sorted(((r.e, r.v) for r in got.collect()), key=repr)
    assert found == [(0, 1.0), (10, None), (7, None), (8, None), (9, None)]


def test_dim_lookup_gives_the_dimension_key(spark):
    fact = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "Ann")], "k string, name string")
    assert rows(dim_lookup(fact, dim, "k", ["name"]).select("v", "k", "name"), "v") == [
        (1, "a", "Ann"),
        (2, None, None),
        (3, None, None),
    ]


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "k string, v int")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    assert rows(orphans(child, "k", parent, "p")) == [("z", 2)]


# --- Ranking ----------------------------------------------------------------------------


def test_top_n(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", None)], "name string, v int")
    assert rows(top_n(df, "v", ["name"])) == [("a", 5)]
    assert rows(top_n(df, "v", ["name"], nulls="first")) == [("c", None)]
    assert rows(top_n(df, "v", ["name"], n=2)) == [("a", 5), ("b", 5)]
    with pytest.raises(ValueError, match="first"):
        top_n(df, "v", [], nulls="maybe")


@pytest.mark.parametrize(
    "bad",
    [
        "{'a': 1}", '{"a": 1} junk', "['a']", '["a"] junk', '["a"]] junk', '["a"]] ["b"]', '["a"], ["b"]',
        '["a"', "[NaN]", "", " ", "junk",
    ],
)
def test_text_that_is_not_json_raises(spark, bad):
    df = spark.createDataFrame([(bad,)], "j string")
    with pytest.raises(Exception, match="(?i)json|malformed"):
        explode_json_array(df, "j", "e").collect()
    with pytest.raises(Exception, match="(?i)json|malformed"):
        df.select(json_fields(F.col("j"), ["a"])).collect()
    assert explode_json_array(df, "j", "e", on_bad="null").collect() == []


def test_json_with_brackets_and_hashes_in_it_is_fine(spark):
    df = spark.createDataFrame([(' ["a]", "[\\"", {"k": [1]}, null]\n',)], "j string")
    assert [r.e for r in explode_json_array(df, "j", "e").collect()] == ["a]", '["', '{"k":[1]}', None]


@pytest.mark.parametrize("text", ["12:30:00", "T12:30:00", "12:30:00+01:00", "now"])
def test_a_time_without_a_date_raises(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="(?i)no date"):
        df.select(to_utc_ntz(F.col("t"))).collect()


def test_different_run_ids_stay_different():
    from minutefold.config import Settings

    keys = {Settings("i", "r", run_id=i).run_key for i in ("a:b", "a+b", "a_b", "a~b", "a~3a~b", "é", "a.b-1")}
    assert len(keys) == 7 and "a_b" in keys and "a.b-1" in keys


def test_partitions_follow_the_spans(spark):
    from minutefold.operators.resample import TASK_BINS, tasks_for

    bins = spark.createDataFrame([("a", 0), ("a", 3 * TASK_BINS), ("b", 7)], "k string, i long")
    assert tasks_for(bins, ["k"], "i") == 4
    assert tasks_for(bins.limit(0), ["k"], "i") == 1


def test_heal_by_key_in_locale_order(spark):
    """Byte order puts every capital before every small letter; a locale does not."""
    df = spark.createDataFrame([(1, "Zeta", 2), (1, "alpha", 3), (2, None, 1), (2, "é", 9), (2, "f", 4)], "k int, t string, n int")
    assert rows(heal_by_key(df, ["k"], ["t", "n"]), "k") == [(1, "alpha", 3), (2, "é", 9)]
    healed = heal_by_key(df, ["k"], ["t", "n"], collation="UNICODE")
    assert rows(healed, "k") == [(1, "Zeta", 3), (2, "f", 9)]
    assert healed.dtypes == df.select("k", "t", "n").dtypes


def test_tasks_of_a_dense_series_follow_its_length(spark, monkeypatch):
    from pyspark.sql import functions as F

    from minutefold.operators import resample

    monkeypatch.setattr(resample, "TASK_BINS", 1024)
    ends = spark.sql("SELECT 'a' AS k, make_timestamp_ntz(2024, 1, d, 0, 0, 0) AS ts, 1.0D AS x FROM VALUES (1), (29) AS t(d)")
    dense = resample.resample_mean(ends, ["k"], "ts", ["x"])
    assert dense.count() == 28 * 1440 + 1
    held = dense.groupBy(F.spark_partition_id().alias("task")).count()
    assert held.count() > 8 and held.agg(F.max("count")).first()[0] < 8 * 1024


def test_the_last_batch_that_holds_a_bin_counts(spark):
    from minutefold.plans.staging import last_batch

    def batch(name, bins):
        return spark.createDataFrame(
            [("h", b, None if b == 2 else name, 0.0, 0.0) for b in bins],
            "hero_id string, timestamp int, heart_rate string, stress_level double, energy_output double",
        )

    found = last_batch([batch("a", [1, 2, 3, 4]), batch("b", [2, 3]), batch("c", [3, 5])])
    assert sorted((r["timestamp"], r["heart_rate"]) for r in found.collect()) == [
        (1, "a"), (2, None), (3, "c"), (4, "a"), (5, "c")
    ]
