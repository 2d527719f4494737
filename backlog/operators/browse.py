"""Browsing: stacked tables, filters, option lists, places on a map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.functions.labels import place_label
from backlog.functions.text import (
    clean_text,
    contains_any,
    matches_search,
    with_values,
    without_county_suffix,
)
from backlog.operators.scope import in_study_processes
from backlog.sources.tables import ProjectTables

# The columns a table view starts with, and those of the cluster view.
TABLE_COLUMNS = (
    "project_name", "queue_position", "study_process", "county", "state", "fuel_types", "net_mw",
    "mw_1", "status",
)
DISPLAY_COLUMNS = (
    "queue_position", "project_name", "fuel_types", "net_mw", "county", "state",
    "application_status", "pto_study_region", "proposed_online_date", "service_type",
)


def _tables_named(tables: ProjectTables, which: str, columns: Sequence[str] | None) -> DataFrame:
    """one status table or all of them."""
    if which == "all":
        return tables.all_projects(columns)
    by_name = {status.lower(): status for status in S.STATUSES}
    if which not in by_name:
        raise ValueError(f"expected one of all, {', '.join(by_name)}: {which!r}")
    return tables.table(by_name[which], columns)


def projects(
    tables: ProjectTables,
    which: str = "all",
    columns: Sequence[str] | None = None,
    study_processes: Sequence[str] | None = None,
) -> DataFrame:
    """B1: the projects of one or all tables, all columns or the chosen ones, with `status`."""
    if columns is None:
        return in_study_processes(_tables_named(tables, which, None), study_processes)
    wanted = list(dict.fromkeys([*columns, "status"]))
    needed = wanted + (["study_process"] if study_processes else [])
    df = _tables_named(tables, which, list(dict.fromkeys(needed)))
    return in_study_processes(df, study_processes).select(*wanted)


def present_columns(df: DataFrame, wanted: Sequence[str] = DISPLAY_COLUMNS) -> DataFrame:
    """The wanted columns that exist."""
    return df.select(*[c for c in wanted if c in df.columns])


def capacity_column(df: DataFrame) -> str | None:
    """F8: the column that stands for capacity."""
    return next((c for c in ("net_mw", "mw_1") if c in df.columns), None)


def filter_projects(
    df: DataFrame,
    fuels: Sequence[str] = (),
    counties: Sequence[str] = (),
    states: Sequence[str] = (),
    min_capacity: float = 0.0,
    search: str = "",
) -> DataFrame:
    """B2: the table view's filters, all of which must hold; an unset filter keeps everything."""
    capacity = capacity_column(df)
    if fuels and "fuel_types" in df.columns:
        df = df.where(contains_any(F.col("fuel_types"), fuels))
    if counties and "county" in df.columns:
        df = df.where(F.col("county").isin(*counties))
    if states and "state" in df.columns:
        df = df.where(F.col("state").isin(*states))
    if min_capacity > 0 and capacity:
        df = df.where(F.coalesce(F.col(capacity), F.lit(0.0)) >= min_capacity)
    if search and "project_name" in df.columns:
        df = df.where(matches_search(F.col("project_name"), search))
    return df


def browse_metrics(df: DataFrame) -> DataFrame:
    """Rows, MW and number of different statuses of a browse result."""
    capacity = capacity_column(df)
    total = F.coalesce(F.sum(capacity), F.lit(0.0)) if capacity else F.lit(None).cast("double")
    statuses = F.count_distinct("status") if "status" in df.columns else F.lit(None).cast("bigint")
    return df.agg(
        F.count("*").alias("total_projects"),
        total.alias("total_mw"),
        statuses.alias("unique_statuses"),
    )


def fuel_categories(df: DataFrame, column: str = "fuel_types", strip: bool = False) -> DataFrame:
    """D3: the single fuels that occur. The strings are made distinct before they are split."""
    fuel = F.explode(F.split(F.col(column), "/")).alias("fuel")
    single = df.select(column).where(F.col(column).isNotNull()).distinct().select(fuel)
    if strip:
        single = single.select(clean_text(F.col("fuel")).alias("fuel"))
    return single.distinct().orderBy("fuel")


def options(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, nulls dropped, sorted."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def county_state_options(df: DataFrame) -> DataFrame:
    """Both option lists under one another, from one scan."""
    choice = F.inline(F.array(
        F.struct(F.lit("county").alias("field"), F.col("county").alias("value")),
        F.struct(F.lit("state").alias("field"), F.col("state").alias("value")),
    ))
    pairs = df.select("county", "state").distinct()
    return pairs.select(choice).where("value is not null").distinct().orderBy("field", "value")


def project_locations(tables: ProjectTables, which: str = "all") -> DataFrame:
    """Projects with a usable place; any other choice of status means all."""
    columns = ["project_name", "county", "state", "net_mw", "latitude", "longitude", "status"]
    known = which in {s.lower() for s in S.STATUSES}
    df = _tables_named(tables, which if known else "all", columns)
    placed = with_values(df, "county", "state", "latitude", "longitude")
    return with_values(
        placed.select(
            "project_name",
            without_county_suffix(F.col("county")).alias("county"),
            "state",
            F.col("net_mw").alias("capacity"),
            F.col("latitude").try_cast("double").alias("latitude"),
            F.col("longitude").try_cast("double").alias("longitude"),
            "status",
        ),
        "latitude",
        "longitude",
    )


def location_rollup(locations: DataFrame) -> DataFrame:
    """One row per place with its map label, most projects first."""
    places = ["county", "state", "latitude", "longitude"]
    return (
        with_values(locations, *places)
        .groupBy(*places)
        .agg(
            F.count("project_name").alias("project_count"),
            F.coalesce(F.sum("capacity"), F.lit(0.0)).alias("total_capacity"),
        )
        .withColumn(
            "label",
            place_label(
                F.col("county"), F.col("state"), F.col("project_count"), F.col("total_capacity")
            ),
        )
        .orderBy(F.desc("project_count"), "county", "state")
    )
