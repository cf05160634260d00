"""One writer at a time, and readers that see committed runs alone."""

import threading
import time

import pytest
from fixture_files import READINGS, rows, write_inputs, write_readings
from test_run import SECOND_READINGS, fail, second_inputs, settings_for, snapshot

from minutefold.plans import run as run_module
from minutefold.plans.run import Layers, append_fact, land, land_readings, run
from minutefold.sources import LeaseLost, RunInProgress, RunLog
from minutefold.sources.runs import Lease
from minutefold.sources.tables import Folder


def committed(log):
    return sorted(r["run_id"] for r in log.committed().collect())


def test_lease_and_commit(spark, folder):
    log = RunLog(spark, f"{folder}/runs")
    assert (committed(log), log.last(), log.failed()) == ([], {}, [])
    with log.lease("a") as lease:
        with pytest.raises(RunInProgress, match="'a'"), log.lease("b"):
            pass
        lease.check()
        assert committed(log) == []
        lease.commit({"n": 1})
        assert committed(log) == ["a"]
    with pytest.raises(RuntimeError, match="lost"), log.lease("b"):
        fail()
    with log.lease("c"):
        pass
    assert (committed(log), log.last()["n"], log.failed()) == (["a"], 1, ["c", "b"])
    with log.lease("b") as lease:
        lease.commit({"n": 2})
    assert (log.is_done("b"), log.is_done("c"), log.failed()) == (True, False, [])
    assert log.leases.names() == []


def test_a_waiting_run_goes_next(spark, folder):
    log = RunLog(spark, f"{folder}/runs")
    done = []

    def second():
        with log.lease("b", wait=60) as lease:
            done.append("b")
            lease.commit({})

    with log.lease("a") as lease:
        waiting = threading.Thread(target=second)
        waiting.start()
        time.sleep(1.0)
        assert done == []
        lease.commit({})
    waiting.join()
    assert (done, committed(log)) == (["b"], ["a", "b"])


def test_a_sleeper_cannot_commit(spark, folder, monkeypatch):
    """A holder that shows no sign for too long is fenced off, before or after the next one commits."""
    monkeypatch.setattr(Lease, "_renew", lambda self: None)
    log = RunLog(spark, f"{folder}/runs")
    with log.lease("a", seconds=0.2) as sleeper:
        time.sleep(0.5)
        with log.lease("b", seconds=0.2) as lease:
            with pytest.raises(LeaseLost):
                sleeper.check()
            with pytest.raises(LeaseLost):
                sleeper.commit({})
            lease.commit({})
        with pytest.raises(LeaseLost):
            sleeper.commit({})
    assert committed(log) == ["b"]


def test_a_renewed_lease_lasts(spark, folder):
    log = RunLog(spark, f"{folder}/runs")
    with log.lease("a", seconds=1.2) as lease:
        time.sleep(2.5)
        with pytest.raises(RunInProgress), log.lease("b", seconds=1.2):
            pass
        lease.commit({})
    assert committed(log) == ["a"]


def test_a_commit_that_was_created_and_not_written(spark, folder):
    log = RunLog(spark, f"{folder}/runs")
    log.leases.make()
    log.leases.create("00000001.json", '{"run_id": "a", "seconds": 0.2}')
    log.commits.make()
    log.commits.create("00000001.json", "")
    time.sleep(0.3)
    with log.lease("b", seconds=0.2) as lease:
        assert log.failed() == ["a"]
        lease.commit({})
    assert committed(log) == ["b"]


def test_a_second_run_between_append_and_commit(spark, folder, monkeypatch):
    """B has appended when another run begins: that one is refused, and no row of B is lost."""
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "A"))
    settings = settings_for(folder, second_inputs(folder), "B")
    layers = Layers(spark, settings)
    commit = Layers.commit
    seen = []

    def overlapped(self, lease, *more):
        with pytest.raises(RunInProgress):
            run(spark, settings_for(folder, folder, "C"))
        seen.append(layers.raw_biometrics.landed())
        commit(self, lease, *more)

    monkeypatch.setattr(Layers, "commit", overlapped)
    run(spark, settings)
    assert seen == [["B"]]  # the refused run took nothing off raw either
    assert committed(layers.log) == ["A", "B"]
    assert layers.models()["fact_biometrics"].count() == 9


def test_a_run_given_up_as_lost_leaves_nothing(spark, folder, monkeypatch):
    """B sleeps past its lease, C takes over and commits, B wakes up."""
    monkeypatch.setattr(Lease, "_renew", lambda self: None)
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "A"))
    settings = settings_for(folder, second_inputs(folder), "B", lease_seconds=1)
    commit = Layers.commit

    def asleep(self, lease, *more):
        monkeypatch.setattr(Layers, "commit", commit)
        time.sleep(1.5)
        run(spark, settings_for(folder, f"{folder}/second", "C", lease_seconds=1000))
        commit(self, lease, *more)

    monkeypatch.setattr(Layers, "commit", asleep)
    with pytest.raises(LeaseLost):
        run(spark, settings)
    layers = Layers(spark, settings)
    assert committed(layers.log) == ["A", "C"]
    fact = layers.models()["fact_biometrics"]
    assert (fact.count(), fact.distinct().count()) == (9, 9)


def test_views_show_committed_runs_alone(spark, folder):
    names = {n: f"{n}_views" for n in ("raw", "staging", "marts", "analytics")}
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "A", layer_names=names))
    settings = settings_for(folder, second_inputs(folder), "B", layer_names=names)
    layers = Layers(spark, settings)
    view = "SELECT count(*) FROM marts_views.fact_biometrics"
    with layers.lease("B") as lease:
        land_readings(layers, spark.read.parquet(f"{folder}/second/biometrics.parquet").selectExpr(
            "timestamp_micros(CAST(timestamp / 1000 AS BIGINT)) AS timestamp", "* EXCEPT (timestamp)"), "B")
        append_fact(layers, layers.staged("B")["stg_biometrics"], "B")
        assert layers.biometrics.read().count() == 9
        assert rows(spark.sql(view)) == [(7,)]
        layers.commit(lease)
        assert rows(spark.sql(view)) == [(9,)]
    with pytest.raises(RuntimeError), layers.lease("D"):
        layers.biometrics.replace(layers.biometrics.read().selectExpr("* EXCEPT (run_id)", "'D' AS run_id"))
        fail()
    assert layers.biometrics.read().count() == 18
    assert rows(spark.sql(view)) == [(9,)]
    assert layers.models()["fact_biometrics"].count() == 9


@pytest.mark.parametrize("step", ["check", "commit", "publish"])
def test_a_crash_leaves_every_table_as_it_was(spark, folder, monkeypatch, step):
    """Between the writes and the commit nothing is switched; after it, everything."""
    write_inputs(folder)
    run(spark, settings_for(folder, folder, "A"))
    settings = settings_for(folder, second_inputs(folder), "B")
    layers = Layers(spark, settings)
    before = snapshot(layers)
    with monkeypatch.context() as m:
        m.setattr(run_module, "check", fail) if step == "check" else m.setattr(Layers, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, settings)
    after = snapshot(layers)
    assert (after == before) == (step != "publish")
    if step != "publish":
        run(spark, settings)
        after = snapshot(layers)
    assert len(after["fact_biometrics"]) == 9
    assert {str(r[1]) for r in after["obt_missions"]} == {"2025-01-01", "2025-01-02"}


def test_leftovers_of_a_killed_driver(spark, folder):
    """A driver dies with its lease and its rows in place; the next run waits the lease out."""
    write_inputs(folder)
    settings = settings_for(folder, folder, "A", lease_seconds=1)
    layers = Layers(spark, settings)
    layers.log.leases.make()
    layers.log.leases.create("00000001.json", '{"run_id": "A", "seconds": 1}')
    layers.create_schemas()
    land(layers, "A")
    append_fact(layers, layers.staged("A")["stg_biometrics"], "A")
    time.sleep(1.2)
    run(spark, settings_for(folder, folder, "B", lease_seconds=1000))
    assert layers.models()["fact_biometrics"].count() == 7
    assert not Folder(spark, layers.biometrics.path).has("run_id=A")


def test_more_readings_than_one_day(spark, folder):
    """Commits of several days each, and the marks they leave."""
    write_inputs(folder)
    for day in (1, 2, 3):
        write_readings(f"{folder}/biometrics.parquet", READINGS if day < 3 else SECOND_READINGS, "us", day)
        run(spark, settings_for(folder, folder, f"day {day}"))
    layers = Layers(spark, settings_for(folder, folder, "x"))
    assert layers.marks()["ts"].startswith("2025-01-03 00:08")
    assert layers.fact().select("day").distinct().count() == 3
