"""Readers, exports, metrics and settings."""

import pytest
from fixture_files import READINGS, at, rows, write_readings
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from minutefold.config import Settings, object_store_settings, scratch_path, shared_folder
from minutefold.plans.schemas import HEROES_FILE, MISSIONS_FILE
from minutefold.sources import LoadMetrics, SourceError, export_csv, export_json, read_csv
from minutefold.sources import read_json, read_parquet

# A failing task surfaces as either.
FAILS = (PySparkException, Py4JError)


def write(folder, name, text):
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)
    return f"{folder}/{name}"


def test_csv_by_name_with_null_tokens_and_quotes(spark, folder):
    path = write(
        folder,
        "h.csv",
        'name,hero_id,first_appearance,extra,alter_ego\n'
        '"a, ""b""",H-1,1971-03-14,x,NA\n'
        "null,H-2,,y,N/A\n"
        "\n"
        " None,H-3,2000,z,none\n",
    )
    assert rows(read_csv(spark, path, HEROES_FILE), "hero_id") == [
        ("H-1", 'a, "b"', None, "1971-03-14"),
        ("H-2", None, None, None),
        ("H-3", " None", "none", "2000"),
    ]


def test_csv_line_breaks_inside_quotes(spark, folder):
    path = write(folder, "h.csv", 'hero_id,name,alter_ego,first_appearance\nH-1,"a\nb",c,d\n')
    assert rows(read_csv(spark, path, HEROES_FILE)) == [("H-1", "a\nb", "c", "d")]


def test_csv_errors_name_the_path(spark, folder):
    with pytest.raises(SourceError, match=f"{folder}/none.csv"):
        read_csv(spark, f"{folder}/none.csv", HEROES_FILE)
    path = write(folder, "short.csv", "hero_id,name\nH-1,a\n")
    with pytest.raises(SourceError, match=f"{path}: no column alter_ego, first_appearance"):
        read_csv(spark, path, HEROES_FILE)
    with pytest.raises(SourceError, match="no path"):
        read_csv(spark, None, HEROES_FILE)


def test_csv_round_trip(spark, folder):
    df = spark.createDataFrame([("H-1", 'x "y", z', None, "d")], HEROES_FILE)
    export_csv(df, f"{folder}/out")
    assert rows(read_csv(spark, f"{folder}/out", HEROES_FILE)) == rows(df)


def test_json_nested_values_become_text(spark, folder):
    path = write(
        folder,
        "m.json",
        '[{"mission_id": "M-1", "hero_ids": ["a", "b"], "damage_report": {"x": 1, "y": null}},'
        ' {"mission_id": "M-2", "hero_ids": [], "location": null, "damage_report": null}]',
    )
    got = read_json(spark, path, MISSIONS_FILE).select("mission_id", "hero_ids", "damage_report")
    assert rows(got, "mission_id") == [
        ("M-1", '["a", "b"]', '{"x": 1, "y": null}'),
        ("M-2", "[]", None),
    ]


def test_json_malformed_raises(spark, folder):
    path = write(folder, "m.json", '[{"mission_id": "M-1"}, {"mission_id": ')
    with pytest.raises(FAILS, match="m.json|Malformed|MALFORMED"):
        read_json(spark, path, MISSIONS_FILE).collect()
    with pytest.raises(SourceError, match="none.json"):
        read_json(spark, f"{folder}/none.json", MISSIONS_FILE)


def test_json_lines_round_trip(spark, folder):
    df = spark.createDataFrame([("M-1", None, "here", "t", "o", None)], MISSIONS_FILE)
    export_json(df, f"{folder}/out")
    assert rows(read_json(spark, f"{folder}/out", MISSIONS_FILE, lines=True)) == rows(df)


@pytest.mark.parametrize("unit", ["ns", "us"])
def test_parquet_timestamps(spark, folder, unit):
    write_readings(f"{folder}/b.parquet", READINGS, unit)
    df = read_parquet(spark, f"{folder}/b.parquet", ["timestamp"])
    assert df.schema["timestamp"].dataType.simpleString() == "timestamp"
    assert df.agg(F.unix_seconds(F.max("timestamp"))).first()[0] == at("00:06:30").timestamp()


def test_parquet_text_timestamps(spark, folder):
    df = spark.createDataFrame([("2025-01-01T00:00:05-05:00",)], "timestamp string")
    df.write.parquet(f"{folder}/t")
    got = read_parquet(spark, f"{folder}/t", ["timestamp"])
    assert got.select(F.col("timestamp").cast("string")).first()[0] == "2025-01-01 05:00:05"
    with pytest.raises(SourceError, match="none.parquet"):
        read_parquet(spark, f"{folder}/none.parquet")


def test_load_metrics(spark, folder):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    m = LoadMetrics("t")
    seen = m.watch(df, "in", ["k"])
    m.watch(seen.where("v > 1"), "out").write.parquet(f"{folder}/t")
    got = m.summary()
    assert (got["in.rows"], got["in.null_k"], got["out.rows"]) == (3, 2, 2)
    assert got["seconds"] > 0


def test_settings_from_environment(monkeypatch):
    monkeypatch.setenv("MINUTEFOLD_EVERY", "5 minutes")
    monkeypatch.setenv("MINUTEFOLD_KEEP_RAW", "true")
    monkeypatch.setenv("MINUTEFOLD_SEVERITY", "error")
    s = Settings.from_env(input_dir="/in", root="/lake/", severity="warn")
    assert (s.every, s.keep_raw, s.severity) == ("5 minutes", True, "warn")
    assert s.path("raw", "heroes") == "/lake/raw/heroes"


def test_run_ids_are_safe_in_paths():
    s = Settings(input_dir="/in", root="/lake", run_id="manual__2025-01-01T00:00:00+00:00")
    assert s.run_key == "manual__2025-01-01T00~3a~00~3a~00~2b~00~3a~00"
    assert Settings(input_dir="/in", root="/lake").run_key != ""


def test_layer_names_are_used_verbatim():
    s = Settings(input_dir="/in", root="/lake", layer_names={"marts": " gold "})
    assert s.path("marts", "t") == "/lake/gold/t"
    assert s.path("raw", "t") == "/lake/raw/t"


def test_object_store_settings():
    got = object_store_settings("http://store:9000", "me", "secret")
    assert got["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert got["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_scratch_is_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(named)


def test_object_store_from_the_environment(monkeypatch):
    from minutefold.config import object_store_from_env

    monkeypatch.delenv("MINUTEFOLD_S3_ENDPOINT", raising=False)
    assert object_store_from_env() == {}
    for name in ("ENDPOINT", "ACCESS_KEY", "SECRET_KEY"):
        monkeypatch.setenv(f"MINUTEFOLD_S3_{name}", name.lower())
    found = object_store_from_env()
    assert found["spark.hadoop.fs.s3a.endpoint"] == "endpoint"
    assert found["spark.hadoop.fs.s3a.secret.key"] == "secret_key"
