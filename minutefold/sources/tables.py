"""Persisted tables of the layers, as Parquet folders that survive a failed run.

* ``BatchTable``: one folder per run; a retry replaces its own batch.
* ``VersionedTable``: every write is a new version, visible once it is complete.
* ``PartTable``: in parts by a value of its rows; a write makes new parts, seen once its
  manifest is there. An upsert rewrites the parts that may hold a key of its batch.
* ``BucketTable``: the same with a hash of the key as the value.
* ``DayTable``: partitioned by day; a write replaces only the partitions it has rows for.
"""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Folder:
    """The few file-system calls the tables need, on any store Hadoop can reach."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._new = jvm.org.apache.hadoop.fs.Path
        self._at = self._new(path)
        self._fs = self._at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _sub(self, name: str):
        return self._new(self._at, name) if name else self._at

    def has(self, name: str = "") -> bool:
        return self._fs.exists(self._sub(name))

    def make(self) -> None:
        self._fs.mkdirs(self._at)

    def names(self, prefix: str = "") -> list[str]:
        if not self.has():
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at)]
        return sorted(n for n in found if n.startswith(prefix))

    def drop(self, name: str = "") -> None:
        self._fs.delete(self._sub(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._sub(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def newest(self, names: list[str]) -> list[str]:
        """The names, those changed last at the end."""
        changed = {n: self._fs.getFileStatus(self._sub(n)).getModificationTime() for n in names}
        return sorted(names, key=lambda n: (changed[n], n))

    def age(self, name: str) -> float:
        """Seconds since the file was written; endless if it is gone."""
        if not self.has(name):
            return float("inf")
        return time.time() - self._fs.getFileStatus(self._sub(name)).getModificationTime() / 1000

    def create(self, name: str, text: str) -> bool:
        """Write a file unless one of the name exists; of several writers one succeeds."""
        try:
            stream = self._fs.create(self._sub(name), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def put(self, name: str, text: str) -> None:
        """Write a file that is there with all of its text or not at all."""
        self.write(f"_{name}.part", text)
        if not self._fs.rename(self._sub(f"_{name}.part"), self._sub(name)):
            raise OSError(f"cannot write {name} in {self._at}")

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._sub(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def claimed(folder: Folder, number: int) -> int:
    """The number, or the next one that no other writer has claimed, one given up as lost neither."""
    folder.make()
    while not folder.create(f"taken-{number:08d}", ""):
        number += 1
    return number


def drop_claims(folder: Folder, upto: int) -> None:
    """Forget claims below the number; those of later writers stay."""
    for name in folder.names("taken-"):
        if int(name.split("-")[1]) < upto:
            folder.drop(name)


def upsert_rows(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key the batch lacks, plus the whole batch; null keys match nothing."""
    replaced = batch.select(*keys).distinct()
    return target.join(replaced, keys, "left_anti").unionByName(batch)


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


class BatchTable:
    """Appended batches, ``<path>/run_id=<run>``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def append(self, df: DataFrame, run_id: str) -> None:
        """Add a batch. Rows of an earlier try of the same run are replaced."""
        _as(df, self.schema).write.mode("overwrite").parquet(f"{self.path}/run_id={run_id}")

    def _batches(self, run_id: str | list[str] | None) -> list[str]:
        folder = Folder(self.spark, self.path)
        if run_id is None:
            wanted = folder.names("run_id=")
        else:
            wanted = [f"run_id={r}" for r in ([run_id] if isinstance(run_id, str) else run_id)]
        return [b for b in wanted if folder.has(f"{b}/_SUCCESS")]

    def landed(self) -> list[str]:
        """Run ids of the complete batches, the one written last at the end."""
        done = {f"{b}/_SUCCESS": b.split("=", 1)[1] for b in self._batches(None)}
        return [done[n] for n in Folder(self.spark, self.path).newest(list(done))]

    def read(self, run_id: str | list[str] | None = None) -> DataFrame:
        """The named batches, or all that are there; a batch is seen once it is complete."""
        paths = [f"{self.path}/{b}" for b in self._batches(run_id)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def truncate(self, run_id: str | None = None) -> None:
        """Drop one batch, or every batch; the table stays and reads as empty."""
        folder = Folder(self.spark, self.path)
        for batch in folder.names("run_id=") if run_id is None else [f"run_id={run_id}"]:
            folder.drop(batch)
        folder.make()


class VersionedTable:
    """Whole-table writes, ``<path>/version=<n>``; readers see the last complete one.

    A write may read the version before it, which an overwrite in place may not.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _versions(self) -> list[int]:
        return [int(n.split("=")[1]) for n in Folder(self.spark, self.path).names("version=")]

    def _complete(self) -> list[int]:
        folder = Folder(self.spark, self.path)
        return [v for v in self._versions() if folder.has(f"{self._name(v)}/_SUCCESS")]

    @staticmethod
    def _name(version: int) -> str:
        return f"version={version:08d}"

    @property
    def current(self) -> str | None:
        """Folder of the last complete version."""
        done = self._complete()
        return f"{self.path}/{self._name(done[-1])}" if done else None

    def read(self, version: str | None = None) -> DataFrame | None:
        """The version in the given folder, or the last complete one."""
        path = version or self.current
        return self.spark.read.parquet(path) if path else None

    def write(self, df: DataFrame) -> str:
        """Write a version; returns its folder."""
        number = claimed(Folder(self.spark, self.path), max(self._versions(), default=0) + 1)
        df.write.parquet(f"{self.path}/{self._name(number)}")
        return f"{self.path}/{self._name(number)}"

    def drop_old(self, keep: list[str] | int = 2) -> None:
        """Drop all but the last complete versions, or but the named ones; readers may still be
        on the one before."""
        folder = Folder(self.spark, self.path)
        names = [self._name(v) for v in self._complete()]
        kept = names[-keep:] if isinstance(keep, int) else [k.rsplit("/", 1)[1] for k in keep if k]
        for name in set(names) - set(kept):
            folder.drop(name)
        drop_claims(folder, max(self._versions(), default=0))


#: Partition column of a table in parts: none of the model's own.
PART = "in_part"
#: Keys that a block of a part's filter is made for, and the bits that each sets in its block.
BLOCK_KEYS, KEY_BITS = 3_000, 5
#: Bits of a block, as ``bitmap_construct_agg`` makes it.
BLOCK_BITS = 32_768
#: Blocks of filters that one task makes: some 400,000 keys, at the most, if hashes are even.
TASK_BLOCKS = 128


def _key_hash(keys: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def _bit_is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, place.bitwiseAND(F.lit(7))) == 1


class PartTable:
    """A table in parts by a value of its rows, a day for instance, that writes replace as wholes.

    ``<path>/data/version=<n>/in_part=<value>`` holds what write n made of a part. A manifest, a file
    of one JSON line per part, names the version of each; a write leaves the manifests before
    it as they are, so a reader, or a log of commits, decides which one counts. A failed write
    leaves nothing but folders that no manifest names.

    An upsert also has to find rows of its keys in other parts, as a row's value may have
    changed. Each part has a Bloom filter of its keys, in blocks of 4 KB, so a batch is probed
    against filters and rewrites the parts that may hold its keys, not the table. ``moves`` is
    false where a key never changes its part; then there are no filters.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        value: Column | str,
        keys: list[str] = (),
        sort_by: list[str] = (),
        moves: bool = True,
    ):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.sort_by, self.moves = list(sort_by), moves and bool(keys)
        value = F.col(value) if isinstance(value, str) else value
        # As folders hold it; null is a part of its own.
        self.value = F.coalesce(value.cast("string"), F.lit("none"))

    @property
    def _folder(self) -> Folder:
        return Folder(self.spark, self.path)

    @property
    def current(self) -> str | None:
        """Name of the last manifest."""
        names = self._folder.names("manifest-")
        return names[-1] if names else None

    def manifest(self, name: str | None = None) -> dict[str, int]:
        """Version by part, of the named manifest or the last."""
        return {v: e["version"] for v, e in self._entries(name).items()}

    def withdraw(self, manifest: str | None) -> None:
        """Make the given manifest the last one again, or none."""
        for name in self._folder.names("manifest-"):
            if manifest is None or name > manifest:
                self._folder.drop(name)

    def _entries(self, name: str | None = None) -> dict[str, dict]:
        """By part its version and the blocks of its filter; an empty name is that of no part."""
        name = self.current if name is None else name
        lines = self._folder.read(name).splitlines() if name else []
        return {entry["part"]: entry for entry in map(json.loads, lines)}

    def _paths(self, entries: dict[str, dict]) -> list[str]:
        return [f"{self.path}/data/version={e['version']}/{PART}={v}" for v, e in sorted(entries.items())]

    def read(self, manifest: str | None = None, parts: list[str] | None = None) -> DataFrame | None:
        """All rows, or those of some parts; None if there are none."""
        named = self._entries(manifest)
        return self._read(named, sorted(named) if parts is None else parts)

    def selects(self, columns: list[str], manifest: str | None = None) -> str:
        """The table as SQL over its files: all versions, less what the manifest does not name."""
        named = f"{self.path}/{self.current if manifest is None else manifest}"
        return (
            f"SELECT {', '.join(f't.`{c}`' for c in columns)} FROM parquet.`{self.path}/data` t "
            f"LEFT SEMI JOIN json.`{named}` m ON t.version = m.version AND CAST(t.{PART} AS STRING) = m.part"
        )

    def _new_version(self) -> int:
        """Above those of all writes, failed ones too, whose folders may still be there."""
        held = Folder(self.spark, f"{self.path}/data").names("version=")
        return claimed(self._folder, 1 + max([int(n.split("=")[1]) for n in held], default=0))

    def _written(self, df: DataFrame, version: int) -> list[str]:
        """Write the parts of a version; returns their values."""
        at = f"data/version={version}"
        (
            df.withColumn(PART, self.value)
            .hint("rebalance", PART)
            .sortWithinPartitions(PART, *self.sort_by)
            .write.partitionBy(PART)
            .parquet(f"{self.path}/{at}")
        )
        return [n.split("=", 1)[1] for n in Folder(self.spark, f"{self.path}/{at}").names(f"{PART}=")]

    def _put(self, entries: dict[str, dict], version: int) -> str:
        text = "".join(json.dumps(e) + "\n" for _, e in sorted(entries.items()))
        self._folder.make()
        self._folder.put(f"manifest-{version:08d}", text)
        return f"manifest-{version:08d}"

    def replace(self, df: DataFrame, manifest: str | None = None) -> str:
        """The named table, or the current one, with the parts that the rows fall into replaced.

        Returns the name of the new manifest.
        """
        version = self._new_version()
        written = self._written(df, version)
        entries = self._entries(manifest)
        entries |= {v: {"part": v, "version": version, "blocks": 0} for v in written}
        return self._put(entries, version)

    def upsert(self, batch: DataFrame) -> list[str]:
        """Replace the rows of the batch's keys by the batch; returns the parts that were written anew."""
        return self.upsert_onto(self.current or "", batch)[1]

    def upsert_onto(self, manifest: str, batch: DataFrame) -> tuple[str | None, list[str]]:
        """The same on the table as the named manifest has it.

        Returns the name of the new manifest too, or the old one for an empty batch.
        """
        named = self._entries(manifest)
        own = {r[0] for r in batch.select(self.value).distinct().collect()}  # at most the parts
        if not own:
            return manifest or None, []
        touched = sorted(own | self._may_hold(batch, named) if self.moves else own)
        held = self._read(named, touched)
        fresh = batch if held is None else upsert_rows(held, batch, self.keys)
        version = self._new_version()
        written = self._written(fresh, version)
        blocks = self._filtered(version, written) if self.moves else {}
        # A part whose rows have all moved is gone.
        kept = {v: e for v, e in named.items() if v not in touched}
        made = {v: {"part": v, "version": version, "blocks": blocks.get(v, 0)} for v in written}
        return self._put(kept | made, version), touched

    def _read(self, named: dict[str, dict], parts: list[str]) -> DataFrame | None:
        paths = self._paths({v: named[v] for v in parts if v in named})
        return self.spark.read.parquet(*paths) if paths else None

    def _filtered(self, version: int, written: list[str]) -> dict[str, int]:
        """Write the filters of a version's parts; returns how many blocks each has.

        A key sets bits in one block only, so a filter grows by blocks and is read by block.
        """
        paths = [f"{self.path}/data/version={version}/{PART}={v}" for v in written]
        rows = self.spark.read.option("basePath", f"{self.path}/data/version={version}").parquet(*paths)
        keyed = rows.select(F.col(PART).cast("string").alias("part"), *self.keys)
        counts = keyed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_KEYS).alias("needed"))
        # Powers of two, so that parts share few sizes. One row per part.
        sizes = {r["part"]: 1 << (r["needed"] - 1).bit_length() for r in counts.collect()}
        of = self.spark.createDataFrame(list(sizes.items()), "of string, blocks int")
        bits = (
            keyed.join(F.broadcast(of), F.col("part") == F.col("of"))  # a row per part
            .select("part", "blocks", self._block(F.col("blocks")).alias("block"), self._places().alias("places"))
            # AQE would deal them out by bytes, and a byte of their shuffle holds many keys.
            .repartition(-(-sum(sizes.values()) // TASK_BLOCKS) or 1, "part", "blocks", "block")
            .select("part", "blocks", "block", F.explode("places").alias("place"))
            .groupBy("part", "blocks", "block")
            .agg(F.bitmap_construct_agg("place").alias("bits"))
        )
        bits.write.parquet(f"{self.path}/filters/version={version}")
        return sizes

    def _block(self, blocks: Column) -> Column:
        return F.pmod(_key_hash(self.keys, 0), blocks).cast("int")

    def _places(self) -> Column:
        """The bits that a key sets in its block."""
        return F.array(*[F.pmod(_key_hash(self.keys, i + 1), F.lit(BLOCK_BITS)) for i in range(KEY_BITS)])

    def _may_hold(self, batch: DataFrame, named: dict[str, dict]) -> set[str]:
        """Parts whose filter has all bits of a key of the batch; null keys are never held."""
        sizes = sorted({e["blocks"] for e in named.values() if e["blocks"]})
        if not sizes:
            return set()
        versions = sorted({e["version"] for e in named.values() if e["blocks"]})
        written = self.spark.read.option("basePath", f"{self.path}/filters").parquet(
            *[f"{self.path}/filters/version={v}" for v in versions]
        )
        live = self.spark.createDataFrame([(e["version"], v) for v, e in named.items()], "version int, part string")
        filters = written.join(F.broadcast(live), ["version", "part"], "left_semi")
        # A key's block hangs on how many a filter has: one probe for each number there is.
        probes = (
            batch.dropna(subset=self.keys).select(*self.keys).distinct()
            .select("*", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("size"), self._places().alias("places"))
            .select("size", self._block(F.col("size")).alias("at"), "places")
        )
        hit = F.lit(True)
        for i in range(KEY_BITS):
            hit &= _bit_is_set(F.col("bits"), F.get("places", F.lit(i)).cast("int"))
        met = filters.join(probes, (F.col("blocks") == F.col("size")) & (F.col("block") == F.col("at"))).where(hit)
        return {r[0] for r in met.select(F.col("part").cast("string")).distinct().collect()}  # at most the parts

    def drop_old(self, keep: list[str] | None = None) -> None:
        """Drop manifests but the named ones, or the last, and folders that none of these names."""
        folder = self._folder
        names = [n for n in (keep if keep is not None else [self.current]) if n]
        named = {(e["version"], v) for n in names for v, e in self._entries(n).items()}
        inside = Folder(self.spark, f"{self.path}/data")
        for version in inside.names("version="):
            number = int(version.split("=")[1])
            held = Folder(self.spark, f"{self.path}/data/{version}").names(f"{PART}=")
            gone = [h for h in held if (number, h.split("=", 1)[1]) not in named]
            for part in gone if len(gone) < len(held) else []:
                inside.drop(f"{version}/{part}")
            if len(gone) == len(held):
                inside.drop(version)
                Folder(self.spark, f"{self.path}/filters").drop(version)
        for old in folder.names("manifest-"):
            if old not in names:
                folder.drop(old)
        drop_claims(folder, max([v for v, _ in named], default=0))


class BucketTable(PartTable):
    """A keyed table dealt by a hash of its key: a key never changes its bucket.

    The number of buckets is that of the first write, whatever is asked for later: rows dealt
    by another number would not be found.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64, sort_by: list[str] = ()):
        folder = Folder(spark, path)
        if folder.has("buckets"):
            buckets = int(folder.read("buckets"))
        self.buckets = buckets
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        super().__init__(spark, path, bucket, keys, sort_by, moves=False)

    def upsert_onto(self, manifest: str, batch: DataFrame) -> tuple[str | None, list[str]]:
        folder = self._folder
        if not folder.has("buckets"):
            folder.make()
            if not folder.create("buckets", str(self.buckets)):
                raise OSError(f"another writer has just begun {self.path}")
        return super().upsert_onto(manifest, batch)


class DayTable:
    """A table in ``<day column>=<date>`` folders, below folders by other columns if given.

    With ``above`` set to a run's id, what a run added is one folder, however many days it has.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str, above: list[str] = ()):
        self.spark, self.path, self.schema, self.day = spark, path, schema, day
        self.parts = [*above, day]

    def last_day(self) -> str | None:
        """The greatest day, from folder names alone, of a table by day only."""
        days = [n.split("=")[1] for n in Folder(self.spark, self.path).names(f"{self.day}=")]
        return max((d for d in days if not d.startswith("__")), default=None)

    def drop(self, value: str) -> None:
        """Drop the folder of a value of the first partition column."""
        Folder(self.spark, self.path).drop(f"{self.parts[0]}={value}")

    def exists(self) -> bool:
        return bool(Folder(self.spark, self.path).names(f"{self.parts[0]}="))

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return (
            self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)
        )

    def replace(self, df: DataFrame) -> None:
        """Write the rows, replacing exactly the partitions they fall into.

        Rows are gathered by partition first, so a day becomes a few files and not
        one from every task; AQE splits a day that is too large for one task.
        """
        (
            _as(df, self.schema)
            .hint("rebalance", *self.parts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.parts)
            .parquet(self.path)
        )
