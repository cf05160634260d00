"""Run settings, session settings and layer names."""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass, field, fields
from datetime import UTC, datetime
from typing import ClassVar

from pyspark.sql import SparkSession

LAYERS = ("raw", "staging", "marts", "analytics")

# The operators rely on these: wall clocks are UTC, bad casts raise, nanosecond
# Parquet timestamps arrive as BIGINT instead of failing the scan, and AQE may
# split a skewed join side even where that costs one more shuffle. A shuffle is cut
# finely, and AQE puts the pieces together by their bytes, so that what a task
# holds does not grow with the input.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "480",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators rely on."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def object_store_settings(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True
) -> dict[str, str]:
    """Builder settings for an S3-compatible store read through ``s3a://`` paths."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def object_store_from_env() -> dict[str, str]:
    """The same from ``MINUTEFOLD_S3_ENDPOINT``, ``_ACCESS_KEY`` and ``_SECRET_KEY``; none without an endpoint."""
    endpoint, access, secret = (
        os.environ.get(f"MINUTEFOLD_S3_{name}", "") for name in ("ENDPOINT", "ACCESS_KEY", "SECRET_KEY")
    )
    return object_store_settings(endpoint, access, secret) if endpoint else {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    Local sessions without one get a folder under the system's temporary folder;
    a cluster session without one is an error, since a machine-local folder would
    be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        import tempfile

        return os.path.join(tempfile.gettempdir(), "minutefold")
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table, below the shared folder."""
    return f"{shared_folder(spark)}/minutefold-{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Settings:
    """One run's locations and policies; every field can come from the environment."""

    input_dir: str
    root: str
    run_id: str = field(default_factory=lambda: f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}")
    heroes_file: str = "heroes.csv"
    missions_file: str = "mission_logs.json"
    biometrics_file: str = "biometrics.parquet"
    heroes_multi_line: bool = True
    heroes_split: bool = False
    missions_are_lines: bool = False
    missions_split: bool = False
    every: str = "1 minute"
    severity: str = "warn"
    keep_raw: bool = False
    lease_seconds: int = 600
    lease_wait: int = 0
    resample_partitions: int = 0
    per_key_mark: bool = False
    arrivals_delay: str = ""
    collation: str = ""
    check_whole_fact: bool = False
    layer_names: dict[str, str] = field(default_factory=lambda: {n: n for n in LAYERS})

    ENV_PREFIX: ClassVar[str] = "MINUTEFOLD_"

    @classmethod
    def from_env(cls, **given) -> "Settings":
        """Fields given as arguments, else ``MINUTEFOLD_<FIELD>``, else the default."""
        values = dict(given)
        for f in fields(cls):
            text = os.environ.get(cls.ENV_PREFIX + f.name.upper())
            if f.name in values or text is None or f.name == "layer_names":
                continue
            kinds = {"bool": lambda x: x.lower() in ("1", "true", "yes"), "int": int}
            values[f.name] = kinds.get(f.type, str)(text)
        return cls(**values)

    @property
    def run_key(self) -> str:
        """The run id as a folder name. Schedulers put colons and plus signs in theirs;
        such signs become their code between tildes, so different ids stay different."""
        return re.sub(r"[^\w.-]", lambda m: f"~{ord(m.group()):x}~", self.run_id, flags=re.ASCII)

    def layer(self, name: str) -> str:
        """Schema name of a layer, used verbatim."""
        return self.layer_names.get(name, name).strip()

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.layer(layer)}/{table}"

    def source(self, file: str) -> str:
        return f"{self.input_dir.rstrip('/')}/{file}"
