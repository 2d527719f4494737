"""Lead times and delays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.functions.dates import days_between_floor, seconds_between
from backlog.functions.text import with_values
from backlog.operators.scope import Family, in_study_processes, projects_of
from backlog.sources.tables import ProjectTables

Filter = Sequence[str] | None

_REQUEST = ["request_receive_date", "queue_date"]
_ONLINE = ["proposed_online_date", "current_online_date"]


def _lead_days(tables: ProjectTables, family: Family, study_processes: Filter) -> DataFrame:
    df = projects_of(tables, S.ACTIVE, _REQUEST, family, study_processes)
    return with_values(df, *_REQUEST).select(
        days_between_floor(F.col("request_receive_date"), F.col("queue_date")).alias("lead_days")
    )


def lead_time(tables: ProjectTables, family: Family, study_processes: Filter = None) -> DataFrame:
    """Mean whole days from request to queue position."""
    mean = F.avg("lead_days")
    if family.empty_as_zero:
        mean = F.coalesce(mean, F.lit(0.0))
    return _lead_days(tables, family, study_processes).agg(mean.alias("average_lead_time_days"))


def lead_time_bands(
    tables: ProjectTables, family: Family, study_processes: Filter = None
) -> DataFrame:
    """Projects per lead-time band."""
    days = F.col("lead_days")
    band = (
        F.when(days < 0, "below 0")
        .when(days < 60, "0-60")
        .when(days < 120, "60-120")
        .otherwise("120+")
    )
    rows = _lead_days(tables, family, study_processes)
    return rows.groupBy(band.alias("band")).agg(F.count("*").alias("project_count"))


def _with_delay(df: DataFrame) -> DataFrame:
    delay = days_between_floor(F.col("proposed_online_date"), F.col("current_online_date"))
    return with_values(df, *_ONLINE).withColumn("delay_days", delay)


def delay_detail(tables: ProjectTables, family: Family) -> DataFrame:
    """Every project with both online dates, and the days between them."""
    columns = ["project_name", S.KEY, *_ONLINE, "fuel_types"]
    df = projects_of(tables, S.ACTIVE, columns, family)
    return _with_delay(df).select(*columns, "delay_days")


def delay_summary(tables: ProjectTables, family: Family) -> DataFrame:
    """Mean, median, range and counts of the delays.

    The projects are first counted per delay, so the exact median works on one row per
    different number of days however many projects there are.
    """
    return summary_of(_with_delay(projects_of(tables, S.ACTIVE, _ONLINE, family)))


def summary_of(detail: DataFrame) -> DataFrame:
    """A13b of rows with delay_days."""
    per_delay = detail.groupBy("delay_days").agg(F.count("*").alias("n"))
    days, n = F.col("delay_days"), F.col("n")

    def rows_where(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    total = F.sum("n")
    delayed = rows_where(days > 0)
    return per_delay.agg(
        F.try_divide(F.sum(days * n).cast("double"), total.cast("double")).alias("average_delay_days"),
        F.percentile(days, 0.5, n).alias("median_delay_days"),
        F.min(days).alias("min_delay_days"),
        F.max(days).alias("max_delay_days"),
        delayed.alias("positive_delay_count"),
        rows_where(days < 0).alias("negative_delay_count"),
        rows_where(days == 0).alias("no_change_count"),
        F.coalesce(
            F.try_divide(delayed.cast("double"), total.cast("double")) * 100, F.lit(0.0)
        ).alias("delay_percentage"),
    )


def delay_by_fuel(tables: ProjectTables, family: Family) -> DataFrame:
    """Mean delay per fuel string, early projects included."""
    return by_fuel_of(_with_delay(projects_of(tables, S.ACTIVE, [*_ONLINE, "fuel_types"], family)))


def by_fuel_of(detail: DataFrame) -> DataFrame:
    """A13c of rows with delay_days and fuel_types."""
    return (
        detail.where(F.col("fuel_types").isNotNull())
        .groupBy(F.col("fuel_types").alias("fuel_type"))
        .agg(F.avg("delay_days").alias("average_delay_days"))
    )


def late_by_fuel(tables: ProjectTables, study_processes: Filter = None) -> DataFrame:
    """A13d: mean delay per fuel string of the late projects only, with fractions, worst first."""
    columns = [*_ONLINE, "fuel_types"] + (["study_process"] if study_processes else [])
    df = in_study_processes(tables.table(S.ACTIVE, columns), study_processes)
    proposed, current = F.col("proposed_online_date"), F.col("current_online_date")
    return (
        df.where(current > proposed)
        .groupBy(F.col("fuel_types").alias("fuel"))
        .agg((F.avg(seconds_between(proposed, current)) / 86400.0).alias("avg_delay_days"))
        .orderBy(F.desc("avg_delay_days"), "fuel")
    )
