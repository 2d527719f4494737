"""Stored project tables: Parquet by snapshot date, and a commit record for each version.

An upsert empties partitions of older snapshots. Overwriting partitions in place would leave
those behind and expose readers to half a load, so a load writes the days it changes next to the old
ones and then commits a record of where each day is; readers follow the newest record. The record is
written aside and renamed, so it is there whole or not at all. A load that dies leaves files nobody
reads; of two loads on top of the same version the second starts anew on top of the first, unless both
are of the same day.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog import schema as S
from backlog.functions.text import is_filled
from backlog.operators import snapshots
from backlog.operators.geo import FIXED_PLACES
from backlog.operators.shape import drop_blank_keys, locate
from backlog.sources.tables import ProjectTables

#: How often a load starts anew because another one has committed first.
TRIES = 5
#: What becomes of a row in a load.
KEPT, REPLACED, SUPERSEDED, WRITTEN, OUTDATED, DROPPED = range(6)
STATE = "_state"


class VersionTaken(RuntimeError):
    """Another load has committed first; load again on top of it."""


@dataclass(frozen=True)
class LoadCounts:
    """What became of the rows of a load, counted by the job that wrote them.

    Read rows are written, or dropped for a blank key or a missing date, or outdated by a newer row of the load
    itself. Stored rows of the same day are replaced, older ones of the same key superseded.
    """

    version: int
    rows_read: int
    rows_dropped: int
    rows_outdated: int
    rows_written: int
    rows_replaced: int
    rows_superseded: int


class StoredTable:
    """One project table under `root/name` in a file system all executors share.

    `data/load=<id>/ingestion_date=<day>` holds what one load wrote; `commits/<version>.json` says which load
    holds each day, and the columns. A load writes the days that it changes and points at the others.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType):
        self.spark = spark
        self.name = name
        self._schema = schema
        self._path = f"{root}/{name}"

    def _at(self, *parts: str):
        """The file system the table is on, and a path below its folder, as Hadoop sees them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self._path, *parts)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, *parts: str) -> list[str]:
        files, folder = self._at(*parts)
        return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []

    def _versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("commits") if n.endswith(".json"))

    def version(self) -> int | None:
        """The newest committed version; None before the first load."""
        return max(self._versions(), default=None)

    def _data(self, load: str | int) -> str:
        return f"{self._path}/data/load={load}"

    def _manifest(self, version: int | None) -> tuple[dict[str, str], T.StructType]:
        """The load that holds each day, by the name of the day's folder; and the columns."""
        if version is None:
            return {}, self._schema
        files, path = self._at("commits", f"{version}.json")
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        commit = json.loads(text)
        return commit["days"], T.StructType.fromJson(commit["schema"])

    def exists(self) -> bool:
        return self.version() is not None

    def newest_date(self, version: int | None = None) -> date | None:
        """The newest snapshot date, from the commit record alone."""
        version = self.version() if version is None else version
        days = [d for d in map(_day_of, self._manifest(version)[0]) if d is not None]
        return max(days, default=None)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of its newest version; an empty one before the first load."""
        version = self.version() if version is None else version
        days, schema = self._manifest(version)
        if not days:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([f for f in schema if f.name != S.SNAPSHOT] + [T.StructField("load", T.StringType()), T.StructField(S.SNAPSHOT, T.DateType())])
        paths = [f"{self._data(load)}/{day}" for day, load in days.items()]
        rows = self.spark.read.schema(stored).option("basePath", f"{self._path}/data").parquet(*paths).select(*schema.names)
        return _under_column_names(rows)

    def _write(self, df: DataFrame, observation: Observation | None = None, *counts: Column) -> dict[str, str]:
        """Write rows as one load. Rebalanced by date: few files per small snapshot, many tasks for a large one.

        Rows with a state are counted past the shuffle, by the tasks that write: a task that is run again counts
        once. Only then those that are not to be stored go.
        """
        load = uuid.uuid4().hex
        rows = df.hint("rebalance", S.SNAPSHOT)
        if observation is not None:
            rows = rows.observe(observation, *counts).where(F.col(STATE).isin(KEPT, WRITTEN)).drop(STATE)
        rows.write.partitionBy(S.SNAPSHOT).parquet(self._data(load))
        return {day: load for day in self._names("data", f"load={load}") if day.startswith(f"{S.SNAPSHOT}=")}

    def _commit(self, base: int | None, days: dict[str, str], schema: T.StructType) -> int:
        """Make version base + 1 out of the days; fails if there is one, as it is not built on that."""
        version = (base or 0) + 1
        jvm = self.spark._jvm
        files, aside = self._at("commits", f".{uuid.uuid4().hex}.tmp")
        _, path = self._at("commits", f"{version}.json")
        stream = files.create(aside, False)
        try:
            stream.write(bytearray(json.dumps({"days": days, "schema": schema.jsonValue()}).encode()))
        finally:
            stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        plain = self.spark.sparkContext._gateway.new_array(rename, 1)
        plain[0] = rename.NONE  # fails where there is a file already
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(aside), files.makeQualified(path), plain)
        except Py4JJavaError as error:
            files.delete(aside, False)
            if "AlreadyExists" in str(error.java_exception):
                raise VersionTaken(f"version {version} of {self.name} is there already") from error
            raise
        return version

    def replace(self, df: DataFrame) -> int:
        """Write and commit the whole table."""
        base = self.version()
        return self._commit(base, self._write(df), df.schema)

    def load(self, incoming: DataFrame, snapshot_date: date) -> int:
        """Load one snapshot; only its day and the days that lose keys are written."""
        return self.load_counted(incoming, snapshot_date).version

    def load_dated(self, incoming: DataFrame) -> int:
        """Load rows of several snapshots, as if one after the other."""
        return self.load_counted(incoming).version

    def load_counted(self, incoming: DataFrame, snapshot_date: date | None = None) -> LoadCounts:
        """A load with its counts (A22): of one snapshot, or of rows that bring their dates.

        The batch is worked out once and staged; a try that loses to another load starts from there.
        """
        dated = incoming if snapshot_date is None else incoming.withColumn(S.SNAPSHOT, F.lit(snapshot_date))
        path = f"{self._path}/incoming/{uuid.uuid4().hex}"
        dated.write.parquet(path)
        try:
            return self._load_staged(self.spark.read.schema(dated.schema).parquet(path), snapshot_date)
        finally:
            files, folder = self._at("incoming", path.rpartition("/")[2])
            files.delete(folder, True)

    def _load_staged(self, batch: DataFrame, snapshot_date: date | None) -> LoadCounts:
        own = {snapshot_date} if snapshot_date else set(_days(_loadable(batch)))
        for _ in range(TRIES):
            base = self.version()
            try:
                return self._load(base, batch, own)
            except VersionTaken:
                before, after = self._manifest(base)[0], self._manifest(self.version())[0]
                changed = {day for day in before.keys() | after.keys() if before.get(day) != after.get(day)}
                if changed & set(map(_folder, own)):
                    raise
        raise VersionTaken(f"{TRIES} loads of {self.name} came first")

    def _load(self, base: int | None, batch: DataFrame, own: set[date | None]) -> LoadCounts:
        stored, rebuild = self._stored(base)
        touched = set() if rebuild else {*own, *_days(snapshots.superseded(stored, _loadable(batch)))}
        rows = self._with_states(stored if rebuild else _on(stored, touched), batch, own)
        counts = Observation()
        metrics = [F.count_if(F.col(STATE) == state).alias(f"s{state}") for state in (KEPT, REPLACED, SUPERSEDED, WRITTEN, OUTDATED, DROPPED)]
        days, schema = ({}, self._schema) if rebuild else self._manifest(base)
        kept = {day: load for day, load in days.items() if day not in set(map(_folder, touched))}
        written = self._write(rows, counts, *metrics)
        known, fields = set(schema.names), [f for f in rows.schema if f.name != STATE]
        schema = T.StructType([*(schema if kept else []), *[f for f in fields if not kept or f.name not in known]])
        version = self._commit(base, kept | written, schema)
        n = counts.get
        return LoadCounts(
            version, n[f"s{WRITTEN}"] + n[f"s{OUTDATED}"] + n[f"s{DROPPED}"], n[f"s{DROPPED}"], n[f"s{OUTDATED}"], n[f"s{WRITTEN}"],
            n[f"s{REPLACED}"], n[f"s{SUPERSEDED}"],
        )

    def _with_states(self, stored: DataFrame, batch: DataFrame, own: set[date | None]) -> DataFrame:
        """Stored and incoming rows under one another, each with what becomes of it."""
        keyed = _loadable(batch)
        newer = F.col(snapshots.NEWEST) > F.col(S.SNAPSHOT)
        same_day = F.coalesce(F.col(S.SNAPSHOT).isin(sorted(d for d in own if d)), F.lit(False))
        old = F.when(same_day, REPLACED).when(newer, SUPERSEDED).otherwise(KEPT)
        usable = is_filled(F.col(S.KEY)) & F.col(S.SNAPSHOT).isNotNull()
        new = F.when(~F.coalesce(usable, F.lit(False)), DROPPED).when(newer, OUTDATED).otherwise(WRITTEN)
        newest = [snapshots.with_newest(df, keyed).withColumn(STATE, state).drop(snapshots.NEWEST) for df, state in ((stored, old), (batch, new))]
        return newest[0].unionByName(newest[1], allowMissingColumns=True)

    def retain(self, as_of: date, weeks: int = 52) -> int:
        """forget the snapshots older than some weeks; no data is written."""
        base = self.version()
        days, schema = self._manifest(base)
        oldest = as_of - timedelta(weeks=weeks)
        kept = {day: load for day, load in days.items() if (_day_of(day) or oldest) >= oldest}
        return self._commit(base, kept, schema)

    def drop_old_versions(self, keep: int = 2) -> list[int]:
        """Forget all but the newest committed versions, and delete the loads only they point at.

        The latest always stays. Keep as many as the longest-running reader may still be reading.
        """
        versions = self._versions()
        old, kept = versions[:-max(keep, 1)], versions[-max(keep, 1):]
        used = {load for v in kept for load in self._manifest(v)[0].values()}
        unused = {load for v in old for load in self._manifest(v)[0].values()} - used
        for parts in [*[("commits", f"{v}.json") for v in old], *[("data", f"load={load}") for load in unused]]:
            files, path = self._at(*parts)
            files.delete(path, True)
        return old

    def duplicate_keys(self) -> DataFrame:
        """V8: keys stored more than once."""
        return snapshots.duplicate_keys(self.read())

    def _stored(self, version: int | None) -> tuple[DataFrame, bool]:
        """The stored rows, and whether all are to be written anew, as none has coordinates yet."""
        stored = self.read(version)
        if {"latitude", "longitude"} <= set(stored.columns):
            return stored, False
        return locate(stored.drop("latitude", "longitude"), FIXED_PLACES), True


def _under_column_names(df: DataFrame) -> DataFrame:
    """What was stored under a raw header comes under its column's name.

    Days stored under the header stay as they are; those loaded since have the column, and either fills it.
    """
    for header, name in S.HEADERS.items():
        if header == name or header not in df.columns:
            continue
        raw = F.col(f"`{header}`").try_cast(S.column_type(name))
        df = df.withColumn(name, F.coalesce(F.col(name), raw) if name in df.columns else raw).drop(header)
    return df


def _folder(day: date | None) -> str:
    return f"{S.SNAPSHOT}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def _day_of(folder: str) -> date | None:
    value = folder.partition("=")[2]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(value)


def _days(df: DataFrame) -> list[date]:
    """The snapshot dates of some rows: one value for each load, not for each row."""
    return [r[0] for r in df.select(S.SNAPSHOT).distinct().collect()]


def _loadable(batch: DataFrame) -> DataFrame:
    """The rows of a batch that have a key and a date."""
    return drop_blank_keys(batch).where(F.col(S.SNAPSHOT).isNotNull())


def _on(df: DataFrame, days: set[date]) -> DataFrame:
    return df.where(F.col(S.SNAPSHOT).isin(sorted(days)))


class StoredTables(ProjectTables):
    """The four tables of a store."""

    def __init__(self, spark: SparkSession, root: str, only: Sequence[str] | None = None):
        names = (*S.TABLE_OF_STATUS.values(), S.CLUSTER_TABLE)
        self.stored = {
            name: StoredTable(
                spark, root, name, S.CLUSTER_SCHEMA if name == S.CLUSTER_TABLE else S.PROJECT_SCHEMA
            )
            for name in names
            if only is None or name in only
        }
        # One version of each table, for its rows and its newest date alike.
        versions = {name: table.version() for name, table in self.stored.items()}
        versions = {name: v for name, v in versions.items() if v is not None}
        present = {name: self.stored[name].read(v) for name, v in versions.items()}
        newest = {name: self.stored[name].newest_date(v) for name, v in versions.items()}
        super().__init__(spark, present, {name: day for name, day in newest.items() if day is not None})


def incoming_rows(df: DataFrame, schema: T.StructType = S.PROJECT_SCHEMA) -> DataFrame:
    """Rows ready to load: keyed, every canonical column there, unknown columns kept as text."""
    keyed = drop_blank_keys(df)
    missing = {
        field.name: F.lit(None).cast(field.dataType)
        for field in schema.fields
        if field.name not in keyed.columns
    }
    return keyed.withColumns(missing) if missing else keyed
