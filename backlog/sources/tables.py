"""The stored project tables as one source: scans, missing tables, union, inventory."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog import schema as S


class ProjectTables:
    """The four project tables of one store. A table that is not there reads as empty.

    `newest`: the newest snapshot date of a table, where its source knows it without reading rows.
    """

    def __init__(
        self, spark: SparkSession, frames: dict[str, DataFrame] | None = None, newest: dict[str, date] | None = None
    ):
        self.spark = spark
        self._frames = frames or {}
        self._newest = newest or {}

    def newest_date(self, status: str) -> date | None:
        """The newest date of a status table; None where it has to be looked for."""
        return self._newest.get(S.TABLE_OF_STATUS[status])

    def names(self) -> list[str]:
        """The tables that exist."""
        return [t for t in (*S.TABLE_OF_STATUS.values(), S.CLUSTER_TABLE) if t in self._frames]

    def scan(self, name: str) -> DataFrame:
        """The whole table, or no rows of the right schema."""
        if name in self._frames:
            return self._frames[name]
        schema = S.CLUSTER_SCHEMA if name == S.CLUSTER_TABLE else S.PROJECT_SCHEMA
        return self.spark.createDataFrame([], schema)

    def columns(self, name: str) -> list[str]:
        """Column names of a table; no columns when it is not there."""
        return self._frames[name].columns if name in self._frames else []

    def table(self, status: str, columns: Sequence[str] | None = None) -> DataFrame:
        """One status table with its `status` column."""
        df = self.scan(S.TABLE_OF_STATUS[status]).withColumn("status", F.lit(status))
        return df if columns is None else df.select(*columns)

    def all_projects(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The three status tables under one another, by column name.

        Columns a table does not have are null there, also when they are asked for by name.
        """
        frames = [self.table(status) for status in S.STATUSES]
        if columns is not None:
            frames = [f.select(*[c for c in columns if c in f.columns]) for f in frames]
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return stacked if columns is None else stacked.select(*columns)

    def cluster(self, columns: Sequence[str] | None = None) -> DataFrame:
        """S3: the cluster requests."""
        df = self.scan(S.CLUSTER_TABLE)
        return df if columns is None else df.select(*columns)


def from_catalog(spark: SparkSession, database: str | None = None) -> ProjectTables:
    """Tables of the session catalog."""
    prefix = f"{database}." if database else ""
    wanted = (*S.TABLE_OF_STATUS.values(), S.CLUSTER_TABLE)
    found = {t: spark.table(prefix + t) for t in wanted if spark.catalog.tableExists(prefix + t)}
    return ProjectTables(spark, found)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the catalog's tables and views."""
    rows = [(t.name, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, is_temporary boolean").orderBy("table_name")


def table_inventory(tables: ProjectTables) -> DataFrame:
    """One row per existing table with its rows, columns and newest snapshot.

    The status tables are counted in one pass.
    """
    existing = tables.names()
    aggregates, rows = [], []
    for status, name in S.TABLE_OF_STATUS.items():
        here = F.col("status") == status
        aggregates += [
            F.count_if(here).alias(f"{status}_rows"),
            F.max(F.when(here, F.col(S.SNAPSHOT))).alias(f"{status}_newest"),
        ]
        if name in existing:
            rows.append(_inventory_row(tables, name, f"{status}_rows", f"{status}_newest"))
    counted = tables.all_projects(["status", S.SNAPSHOT]).agg(*aggregates)
    inventory = counted.select(F.inline(F.array(*rows))) if rows else None
    if S.CLUSTER_TABLE in existing:
        newest = F.max(S.SNAPSHOT).alias("newest")
        cluster = tables.cluster([S.SNAPSHOT]).agg(F.count("*").alias("rows"), newest)
        row = F.array(_inventory_row(tables, S.CLUSTER_TABLE, "rows", "newest"))
        cluster = cluster.select(F.inline(row))
        inventory = cluster if inventory is None else inventory.unionByName(cluster)
    if inventory is None:
        empty = "table_name string, row_count bigint, column_count int, latest_snapshot date"
        return tables.spark.createDataFrame([], empty)
    return inventory


def _inventory_row(tables: ProjectTables, name: str, rows: str, newest: str) -> Column:
    return F.struct(
        F.lit(name).alias("table_name"),
        F.col(rows).alias("row_count"),
        F.lit(len(tables.columns(name))).alias("column_count"),
        F.col(newest).alias("latest_snapshot"),
    )


def table_columns(df: DataFrame, name: str) -> DataFrame:
    """Position, name, type of a table's columns, and how many rows fill each (one scan)."""
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns])
    described = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col(f"`{field.name}`").alias("filled_rows"),
        )
        for i, field in enumerate(df.schema.fields, start=1)
    ])
    return counts.select(F.lit(name).alias("table_name"), F.inline(described))


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """A few rows to look at."""
    return df.limit(n)
