"""The whole run on the fixtures: one batch, a second batch, retries."""

import os

import pytest
from fixture_files import MISSIONS, READINGS, clock, mission, rows, write_inputs, write_readings
from pyspark.sql import functions as F

from minutefold.config import Settings
from minutefold.operators.quality import QualityError
from minutefold.plans import questions
from minutefold.plans import run as run_module
from minutefold.plans.run import MODEL_LAYERS, Layers, build, land, run, run_arrivals
from minutefold.sources.tables import Folder


def settings_for(folder, inputs, run_id, **more):
    return Settings(input_dir=inputs, root=f"{folder}/lake", run_id=run_id, **more)


@pytest.fixture(scope="module", params=["ns", "us"])
def first(request, spark):
    import tempfile

    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write_inputs(folder, unit=request.param)
    settings = settings_for(folder, folder, "one", keep_raw=True)
    result = run(spark, settings)
    return Layers(spark, settings), result


def test_staging(first):
    layers, _ = first
    staged = layers.staged()
    assert rows(staged["stg_heroes"].select("hero_id", "name", "alter_ego", "first_appearance"), "hero_id") == [
        ("kx07", "mrpaperweight", 'Jo "Stapler" Lund', "1998-10-01"),
        ("kx12", "greyotter", "Sanna Virtala", "2003-05-05"),
        ("kx31", "ökonom", "Ruth Abara", "2011-02-28"),
        ("kx44", "ninety9", None, "1986-07-07"),
    ]
    missions = rows(
        staged["stg_missions"].select("mission_id", "hero_id", "timestamp", "structural_damage"),
        "mission_id",
        "hero_id",
    )
    risky = clock("00:03:59").replace(microsecond=500_000)
    assert missions == [
        ("op-20", "kx07", clock("00:04:10"), "10000"),
        ("op-21", "ghost", risky, "31000"),
        ("op-21", "kx07", risky, "31000"),
        ("op-21", "kx44", risky, "31000"),
        ("op-23", "kx31", clock("00:02"), "-7"),
        ("op-24", "kx12", clock("09:30"), None),
        ("op-25", "kx44", clock("00:05:30"), "12500"),
    ]
    biometrics = rows(staged["stg_biometrics"], "hero_id", "timestamp")
    assert biometrics == [
        (clock("00:02"), "kx07", 64.0, 3.0, 50.0),
        (clock("00:03"), "kx07", None, None, None),
        (clock("00:04"), "kx07", 66.0, 1.0, 30.0),
        (clock("00:05"), "kx07", None, None, None),
        (clock("00:06"), "kx07", 61.0, 4.0, 10.0),
        (clock("00:02"), "kx31", 71.0, 8.0, 90.0),
        (clock("00:05"), "kx44", None, 6.0, 700.0),
    ]


def test_marts(first):
    models = first[0].models()
    assert models["dim_heroes"].schema["first_appearance"].dataType.simpleString() == "date"
    assert models["dim_missions_heroes"].schema["structural_damage"].dataType.simpleString() == "int"
    assert models["fact_biometrics"].count() == 7


def test_wide_tables(first):
    models = first[0].models()
    by_bin = rows(
        models["obt_biometrics"].select(
            "timestamp", "hero_name", "hero_id", "mission_id", "mission_location",
            "mission_outcome", "structural_damage", "heart_rate", "stress_level", "energy_output",
        ),
        "hero_id",
        "timestamp",
    )
    none = (None, None, None, None)
    assert by_bin == [
        (clock("00:02"), "mrpaperweight", "kx07", *none, 64.0, 3.0, 50.0),
        (clock("00:03"), "mrpaperweight", "kx07", "op-21", "Ring Road", "Successful", 31000, None, None, None),
        (clock("00:04"), "mrpaperweight", "kx07", "op-20", "Harbour 9", "Compromised", 10000, 66.0, 1.0, 30.0),
        (clock("00:05"), "mrpaperweight", "kx07", *none, None, None, None),
        (clock("00:06"), "mrpaperweight", "kx07", *none, 61.0, 4.0, 10.0),
        (clock("00:02"), "ökonom", "kx31", "op-23", None, "Abandoned", -7, 71.0, 8.0, 90.0),
        (clock("00:05"), "ninety9", "kx44", "op-25", "Mill", "Failed", 12500, None, 6.0, 700.0),
    ]
    by_mission = rows(
        models["obt_missions"].select(
            "mission_timestamp", "hero_name", "hero_id", "mission_id", "mission_outcome",
            "structural_damage", "heart_rate", "stress_level", "energy_output",
        ),
        "mission_id",
        F.col("hero_id").desc(),
    )
    risky = clock("00:03:59").replace(microsecond=500_000)
    assert by_mission == [
        (clock("00:04:10"), "mrpaperweight", "kx07", "op-20", "Compromised", 10000, 66.0, 1.0, 30.0),
        (risky, "ninety9", "kx44", "op-21", "Successful", 31000, None, None, None),
        (risky, "mrpaperweight", "kx07", "op-21", "Successful", 31000, None, None, None),
        (risky, None, None, "op-21", "Successful", 31000, None, None, None),
        (clock("00:02"), "ökonom", "kx31", "op-23", "Abandoned", -7, 71.0, 8.0, 90.0),
        (clock("09:30"), "greyotter", "kx12", "op-24", "Successful", None, None, None, None),
        (clock("00:05:30"), "ninety9", "kx44", "op-25", "Failed", 12500, None, 6.0, 700.0),
    ]


def test_wide_schemas(first):
    models = first[0].models()
    tail = [("structural_damage", "int")] + [
        (m, "double") for m in ("heart_rate", "stress_level", "energy_output")
    ]
    names = ["hero_name", "alter_ego", "hero_id", "mission_id", "mission_location", "mission_outcome"]
    texts = [(n, "string") for n in names]
    assert models["obt_biometrics"].dtypes == [("timestamp", "timestamp_ntz"), *texts, *tail]
    assert models["obt_missions"].dtypes == [
        ("mission_timestamp", "timestamp_ntz"), ("mission_date", "date"), *texts, *tail,
    ]


def test_questions(first):
    models = first[0].models()
    by_bin, by_mission = models["obt_biometrics"], models["obt_missions"]
    q1a = questions.strongest_under_risk(by_bin, on_missions_only=True, nulls="first")
    assert rows(q1a) == [("mrpaperweight", None)]
    assert rows(questions.strongest_under_risk(by_mission)) == [("ninety9", 700.0)]
    assert rows(questions.most_reliable(by_bin, nulls="first")) == [("mrpaperweight", 1, None)]
    assert rows(questions.most_reliable(by_mission)) == [("greyotter", 1, None)]
    assert questions.preview(by_bin, 2).count() == 2


def test_questions_as_sql(first, spark):
    first[0].publish({"obt_missions": "wide"})
    found = spark.sql(
        "SELECT hero_name, avg(energy_output) AS e FROM analytics.wide "
        "WHERE structural_damage > 10000 "
        "GROUP BY hero_name ORDER BY e DESC NULLS LAST LIMIT 1"
    )
    assert rows(found) == [("ninety9", 700.0)]
    assert spark.table("marts.fact_biometrics").count() == 7
    assert spark.table("marts.fact_biometrics").columns[:2] == ["timestamp", "hero_id"]
    assert spark.table("stg_heroes").count() == 4
    assert spark.table("raw.heroes").count() == 8


def test_checks(first):
    failed = {
        (c["model"], c["test"], c["column"]): c["failures"]
        for c in first[1]["checks"]
        if c["status"] != "pass"
    }
    assert len(first[1]["checks"]) == 18
    assert failed == {
        ("obt_biometrics", "between", "structural_damage"): 1,
        ("obt_biometrics", "in_set", "mission_outcome"): 1,
        ("dim_missions_heroes", "in_parent", "hero_id"): 1,
    }


def test_load_metrics(first):
    loads = {s["load"]: s for s in first[1]["loads"]}
    assert loads["heroes"]["out.rows"] == 8
    assert loads["missions"]["out.rows"] == 8
    assert loads["biometrics"]["in.rows"] == 7
    assert loads["biometrics"]["in.null_hero_id"] == 1
    assert loads["biometrics"]["out.rows"] == 7


def test_severity_error(spark, folder):
    write_inputs(folder)
    with pytest.raises(QualityError, match="mission_outcome"):
        run(spark, settings_for(folder, folder, "one", severity="error"))


SECOND_HEROES = """hero_id,name,alter_ego,first_appearance
kx58,Late-Comer,Ada Quist,2020-02-29
kx31,Ökonom II,Ruth Abara,2011-02-28
kx07,Mr Paperweight,Jo Lund,1998-10-01
"""
SECOND_MISSIONS = [
    mission("op-30", ["kx58"], "Quarry", "2025-01-02T00:07:30+00:00", "Successful", (100, 0)),
    mission("op-21", ["kx07"], "Ring Road", "2025-01-01T00:03:59.500Z", "Failed", (31000, 0)),
]
SECOND_READINGS = [
    ("00:06:10", "kx07", 99.0, 9.0, 999),
    ("00:07:10", "kx07", 60.0, 1.0, 10),
    ("00:08:20", "kx07", 62.0, 1.0, 20),
]


def second_inputs(folder):
    os.makedirs(f"{folder}/second")
    return write_inputs(f"{folder}/second", SECOND_HEROES, SECOND_MISSIONS, SECOND_READINGS)


def test_second_run(spark, folder):
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "one"))
    settings = settings_for(folder, second_inputs(folder), "two")
    layers = Layers(spark, settings)
    assert layers.raw_biometrics.read().count() == 0  # emptied by the first run
    result = run(spark, settings)
    models = layers.models()

    assert rows(models["dim_heroes"].select("hero_id", "name"), "hero_id") == [
        ("kx07", "mrpaperweight"),
        ("kx12", "greyotter"),
        ("kx31", "ökonomii"),
        ("kx44", "ninety9"),
        ("kx58", "latecomer"),
    ]
    outcomes = models["dim_missions_heroes"].where("mission_id in ('op-21', 'op-30')")
    assert rows(outcomes.select("mission_id", "hero_id", "outcome"), "mission_id", "hero_id") == [
        ("op-21", "ghost", "Successful"),
        ("op-21", "kx07", "Failed"),
        ("op-21", "kx44", "Successful"),
        ("op-30", "kx58", "Successful"),
    ]
    fact = {s["load"]: s for s in result["loads"]}["fact_biometrics"]
    assert (fact["in.rows"], fact["out.rows"], fact["late"]) == (3, 2, 1)
    assert models["fact_biometrics"].count() == 9
    # The biometrics table holds the current batch only.
    assert models["obt_biometrics"].count() == 3
    # The mission table: the last loaded day again, later days added.
    found = models["obt_missions"].select("mission_date", "mission_id", "hero_name", "mission_outcome")
    assert [(str(d), *r) for d, *r in rows(found, "mission_id", "hero_name")] == [
        ("2025-01-01", "op-20", "mrpaperweight", "Compromised"),
        ("2025-01-01", "op-21", None, "Successful"),
        ("2025-01-01", "op-21", "mrpaperweight", "Failed"),
        ("2025-01-01", "op-21", "ninety9", "Successful"),
        ("2025-01-01", "op-23", "ökonomii", "Abandoned"),
        ("2025-01-01", "op-24", "greyotter", "Successful"),
        ("2025-01-01", "op-25", "ninety9", "Failed"),
        ("2025-01-02", "op-30", "latecomer", "Successful"),
    ]


def test_command_line(spark, folder, capsys, monkeypatch):
    import json

    from minutefold.__main__ import main

    monkeypatch.setenv("MINUTEFOLD_KEEP_RAW", "true")
    write_inputs(folder)
    main(["--input-dir", folder, "--root", f"{folder}/lake", "--run-id", "a:b"])
    result = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(result["checks"]) == 18
    assert Layers(spark, settings_for(folder, folder, "a:b")).raw_heroes.read("a~3a~b").count() == 8


def test_checks_from_the_mark_on(spark, folder):
    """The second run's fact checks may leave out the days before its mark."""
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "one"))
    inputs = second_inputs(folder)
    write_readings(f"{inputs}/biometrics.parquet", SECOND_READINGS, day=3)
    settings = settings_for(folder, inputs, "two", check_whole_fact=False)
    layers = Layers(spark, settings)
    run(spark, settings)
    layers.settings = settings_for(folder, inputs, "three", check_whole_fact=False)
    write_readings(f"{inputs}/biometrics.parquet", [("00:00:10", "Z-1", 1.0, 1.0, 1)], day=4)
    lost = {
        (c["model"], c["test"]): c["failures"]
        for c in run(spark, layers.settings)["checks"]
        if c["test"] == "in_parent"
    }
    assert lost[("fact_biometrics", "in_parent")] == 1


def test_a_batch_that_adds_nothing(spark, folder):
    """No mission, no hero, and only readings that are late: the tables stay as they are."""
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "one"))
    os.makedirs(f"{folder}/second")
    header = "hero_id,name,alter_ego,first_appearance\n"
    inputs = write_inputs(f"{folder}/second", header, [], READINGS[:2])
    settings = settings_for(folder, inputs, "two")
    before = snapshot(Layers(spark, settings))
    result = run(spark, settings)
    loads = {s["load"]: s for s in result["loads"]}
    assert (loads["heroes"]["out.rows"], loads["missions"]["out.rows"]) == (0, 0)
    fact = loads["fact_biometrics"]
    assert (fact["in.rows"], fact["out.rows"], fact["late"]) == (1, 0, 1)
    after = snapshot(Layers(spark, settings))
    assert len(after.pop("obt_biometrics")) == 1
    before.pop("obt_biometrics")
    assert after == before


def test_no_readings_at_all(spark, folder):
    write_inputs(folder, readings=[("00:00:05", None, 80.0, 1.0, 100)])
    settings = settings_for(folder, folder, "one")
    result = run(spark, settings)
    assert {s["load"]: s for s in result["loads"]}["biometrics"]["out.rows"] == 0
    models = Layers(spark, settings).models()
    assert (models["fact_biometrics"].count(), models["obt_missions"].count()) == (0, 7)
    assert questions.most_reliable(models["obt_biometrics"]).count() == 0


def test_kept_raw_is_history(spark, folder):
    """Kept batches stay readable and do not enter the next run again."""
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "one", keep_raw=True))
    settings = settings_for(folder, second_inputs(folder), "two", keep_raw=True)
    result = run(spark, settings)
    layers = Layers(spark, settings)
    assert layers.raw_heroes.read().count() == 11
    fact = {s["load"]: s for s in result["loads"]}["fact_biometrics"]
    assert (fact["in.rows"], fact["out.rows"]) == (3, 2)
    assert layers.models()["obt_biometrics"].count() == 3


def test_raw_left_by_a_failed_run_enters_the_next(spark, folder):
    write_inputs(folder)
    failed = Layers(spark, settings_for(folder, folder, "one"))
    failed.create_schemas()
    land(failed, "one")  # and then the run is given up
    settings = settings_for(folder, second_inputs(folder), "two")
    run(spark, settings)
    models = Layers(spark, settings).models()
    assert models["dim_heroes"].count() == 5
    assert Layers(spark, settings).raw_heroes.read().count() == 0


def fail(*_, **__):
    raise RuntimeError("the run is lost here")


@pytest.mark.parametrize("step", ["build", "check", "commit"])
def test_a_failed_run_and_another_id(spark, folder, monkeypatch, step):
    """A fails somewhere, B takes the same files, and A is tried again."""
    write_inputs(folder)
    first = settings_for(folder, folder, "A")
    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(Layers, "commit", fail)
        else:
            m.setattr(run_module, step, fail)
        with pytest.raises(RuntimeError):
            run(spark, first)
    run(spark, settings_for(folder, folder, "B"))
    fact = Layers(spark, first).models()["fact_biometrics"]
    assert (fact.count(), fact.distinct().count()) == (7, 7)
    run(spark, first)
    assert Layers(spark, first).models()["fact_biometrics"].count() == 7


def test_a_day_lost_while_a_run_was_committing(spark, folder, monkeypatch):
    """Readings of three days, of which the middle one did not get into place."""
    write_inputs(folder)
    late = f"{folder}/late"
    os.makedirs(late)
    for day in (1, 2, 3):
        write_readings(f"{late}/{day}.parquet", READINGS, "us", day)
    settings = settings_for(folder, folder, "A", biometrics_file="late")
    with monkeypatch.context() as m:
        m.setattr(Layers, "commit", fail)
        with pytest.raises(RuntimeError):
            run(spark, settings)
    layers = Layers(spark, settings)
    assert layers.biometrics.read().select("day").distinct().count() == 3
    Folder(spark, layers.biometrics.path).drop("run_id=A/day=2025-01-02")
    run(spark, settings_for(folder, folder, "B", biometrics_file="late"))
    whole = layers.biometrics.read()
    assert whole.groupBy("hero_id", "timestamp").count().where("count > 1").isEmpty()
    assert whole.select("day").distinct().count() == 3
    assert whole.count() == layers.models()["obt_biometrics"].dropDuplicates(["hero_id", "timestamp"]).count()


def test_the_batch_landed_last_counts(spark, folder):
    write_inputs(folder)
    failed = Layers(spark, settings_for(folder, folder, "z-first"))
    failed.create_schemas()
    land(failed, "z-first")
    inputs = f"{folder}/second"
    os.makedirs(inputs)
    write_inputs(inputs, readings=[("00:02:05", "kx07", 11.0, 1.0, 100)])
    settings = settings_for(folder, inputs, "a-second")
    run(spark, settings)
    fact = Layers(spark, settings).models()["fact_biometrics"].where("hero_id = 'kx07'")
    assert rows(fact.select("heart_rate"), "timestamp") == [(11.0,), (None,), (66.0,), (None,), (61.0,)]


def test_models_are_readable_after_any_number_of_runs(spark, folder):
    write_inputs(folder)
    for number in range(4):
        settings = settings_for(folder, folder, f"run {number}")
        run(spark, settings)
        for model, layer in MODEL_LAYERS.items():
            if layer != "staging":
                found = spark.table(f"`{settings.layer(layer)}`.`{model}`")
                assert found.count() == Layers(spark, settings).models()[model].count()
    assert spark.table("analytics.obt_missions").count() == 7


def test_failed_checks_change_nothing_that_was_current(spark, folder):
    write_inputs(folder, missions=[MISSIONS[1]])
    settings = settings_for(folder, folder, "one")
    run(spark, settings)
    before = snapshot(Layers(spark, settings))
    inputs = second_inputs(folder)
    write_inputs(inputs, SECOND_HEROES, MISSIONS, SECOND_READINGS)
    with pytest.raises(QualityError):
        run(spark, settings_for(folder, inputs, "two", severity="error"))
    after = snapshot(Layers(spark, settings))
    assert after == before  # the replaced days of the mission table too


def snapshot(layers, record=None):
    return {
        name: sorted(map(tuple, df.collect()), key=repr) for name, df in layers.models(record).items()
    }


def test_retry_gives_the_same_tables(spark, folder):
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "one"))
    inputs = second_inputs(folder)
    layers = Layers(spark, settings_for(folder, inputs, "two"))
    before = snapshot(layers)
    land(layers, "two")
    _, record = build(layers, "two")  # and then the driver is lost
    once = snapshot(layers, record)
    assert snapshot(layers) == before != once
    run(spark, settings_for(folder, inputs, "two"))
    assert snapshot(layers) == once
    with pytest.raises(ValueError, match="complete"):
        run(spark, settings_for(folder, inputs, "two"))


def test_per_key_mark(spark, folder):
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "one"))
    os.makedirs(f"{folder}/second")
    late = [("00:03:10", "kx31", 50.0, 1.0, 10), ("00:05:10", "kx07", 50.0, 1.0, 10)]
    inputs = write_inputs(f"{folder}/second", readings=late)
    settings = settings_for(folder, inputs, "two", per_key_mark=True)
    result = run(spark, settings)
    fact = {s["load"]: s for s in result["loads"]}["fact_biometrics"]
    assert (fact["out.rows"], fact["late"]) == (1, 1)
    assert Layers(spark, settings).models()["fact_biometrics"].count() == 8


def test_arrivals(spark, folder):
    """Reading files that arrive one after the other, each applied once."""
    os.makedirs(f"{folder}/landing")
    settings = settings_for(folder, folder, "stream")
    layers = Layers(spark, settings)
    seen = []
    for i, batch in enumerate([READINGS, SECOND_READINGS, None]):
        if batch:
            write_readings(f"{folder}/landing/{i}.parquet", batch, "us")
        schema = spark.read.parquet(f"{folder}/landing").schema
        stream = spark.readStream.schema(schema).parquet(f"{folder}/landing")
        run_arrivals(spark, settings, stream, f"{folder}/checkpoint", close=True)
        seen.append(layers.models()["fact_biometrics"].count())
    assert seen == [7, 9, 9]
    assert layers.raw_biometrics.read().count() == 0


def test_json_lines_input(spark, folder):
    import json

    write_inputs(folder)
    with open(f"{folder}/lines.json", "w") as f:
        f.writelines(json.dumps(m) + "\n" for m in MISSIONS)
    settings = settings_for(
        folder, folder, "one", missions_file="lines.json", missions_are_lines=True
    )
    run(spark, settings)
    assert Layers(spark, settings).models()["dim_missions_heroes"].count() == 7


def test_rows_of_one_run_are_not_gathered_in_one_task(spark, folder):
    layers = Layers(spark, Settings(input_dir=folder, root=f"{folder}/lake"))
    plan = layers.fact("one")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
