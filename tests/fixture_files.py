"""Hand-written inputs with every kind of dirt the pipeline has to decide on."""

import json
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq

HEROES = """hero_id,name,alter_ego,first_appearance
,grey otter,Sanna Virtala,2003-05-05
kx12,Grey-Otter!,Sanna Virtala,
kx07,MR. PAPERWEIGHT,"Jo ""Stapler"" Lund",1998-10-01
kx31,Ökonom,,2010-02-28
kx44,Ninety 9,N/A,1986-07-07
kx12,,,2003-05-05
kx31,Ökonom,Ruth Abara,2011-02-28
kx31,,Ruth Abara,2011-02-28
"""


def mission(mission_id, heroes, location, timestamp, outcome, damage=None):
    record = {
        "mission_id": mission_id,
        "hero_ids": heroes,
        "location": location,
        "timestamp": timestamp,
        "outcome": outcome,
    }
    if damage is not None:
        record["damage_report"] = {"structural_damage": damage[0], "civilian_injuries": damage[1]}
    return record


MISSIONS = [
    mission(None, ["kx07", "kx12"], None, "2025-01-01T00:00:00Z", "Successful", (9, 9)),
    mission("op-20", ["kx07"], "Harbour 9", "2025-01-01T01:04:10+01:00", "Compromised", (10000, 2)),
    mission("op-21", ["kx44", "kx07", "ghost"], "Ring Road", "2025-01-01T00:03:59.500Z", "Successful", (31000, 0)),
    mission("op-22", None, "Quarry", "2025-01-01T00:01:00+00:00", "Failed", (1, 1)),
    mission("op-23", ["kx31"], None, "2025-01-01T05:47:00+05:45", "Abandoned", (-7, 3)),
    mission("op-24", ["kx12"], "Ring Road", "2025-01-01T09:30:00+00:00", "Successful"),
    mission("op-23", ["kx31"], None, "2024-12-31T18:02:00-06:00", "Abandoned", (-7, 3)),
    mission("op-25", ["kx44"], "Mill", "2025-01-01T00:05:30+00:00", "Failed", (12500, 1)),
]

READINGS = [
    ("00:02:00", "kx07", None, 2.5, 40),
    ("00:02:20", "kx07", 64.0, 3.5, 60),
    ("00:02:41", "kx31", 71.0, 8.0, 90),
    ("00:02:59", None, 70.0, 5.0, 500),
    ("00:04:59", "kx07", 66.0, 1.0, 30),
    ("00:05:00", "kx44", None, 6.0, 700),
    ("00:06:30", "kx07", 61.0, 4.0, 10),
]


def at(text, day=1):
    h, m, s = (int(x) for x in text.split(":"))
    return datetime(2025, 1, day, h, m, s, tzinfo=UTC)


def clock(text, day=1):
    return at(text if text.count(":") == 2 else text + ":00", day).replace(tzinfo=None)


def write_readings(path, rows, unit="ns", day=1):
    columns = list(zip(*rows, strict=True))
    table = pa.table(
        {
            "timestamp": pa.array([at(t, day) for t in columns[0]], pa.timestamp(unit, "UTC")),
            "hero_id": pa.array(columns[1], pa.string()),
            "heart_rate": pa.array(columns[2], pa.float64()),
            "stress_level": pa.array(columns[3], pa.float64()),
            "energy_output": pa.array(columns[4], pa.int64()),
        }
    )
    pq.write_table(table, path, version="2.6")


def write_inputs(folder, heroes=HEROES, missions=MISSIONS, readings=READINGS, unit="ns", day=1):
    with open(f"{folder}/heroes.csv", "w", encoding="utf-8") as f:
        f.write(heroes)
    with open(f"{folder}/mission_logs.json", "w") as f:
        json.dump(missions, f, indent=4)
    write_readings(f"{folder}/biometrics.parquet", readings, unit, day)
    return folder


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
