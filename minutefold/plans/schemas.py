"""File schemas and table columns, equal to those users query today."""

from pyspark.sql import types as T

TEXT, INSTANT, CLOCK, DAY = T.StringType(), T.TimestampType(), T.TimestampNTZType(), T.DateType()
NUMBER, WHOLE = T.DoubleType(), T.IntegerType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


HEROES_FILE = _table(hero_id=TEXT, name=TEXT, alter_ego=TEXT, first_appearance=TEXT)
# Nested values stay JSON text.
MISSIONS_FILE = _table(
    mission_id=TEXT, hero_ids=TEXT, location=TEXT, timestamp=TEXT, outcome=TEXT, damage_report=TEXT
)
MEASURES = ["heart_rate", "stress_level", "energy_output"]
DAMAGES = ["structural_damage", "civilian_injuries"]
_MEANS = dict.fromkeys(MEASURES, NUMBER)

RAW_HEROES = HEROES_FILE
RAW_MISSIONS = MISSIONS_FILE
RAW_BIOMETRICS = _table(hero_id=TEXT, timestamp=INSTANT, **_MEANS)
# The last two columns are partitions and no part of the model.
FACT_BIOMETRICS = _table(timestamp=CLOCK, hero_id=TEXT, **_MEANS, day=DAY, run_id=TEXT)
MISSION_WIDE = _table(
    mission_timestamp=CLOCK,
    mission_date=DAY,
    hero_name=TEXT,
    alter_ego=TEXT,
    hero_id=TEXT,
    mission_id=TEXT,
    mission_location=TEXT,
    mission_outcome=TEXT,
    structural_damage=WHOLE,
    **_MEANS,
)
