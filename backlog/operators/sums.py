"""KPIs from sums kept per snapshot (A1-A8, A10, A15, A16, A24): one row per day and group, not one per project.

The sums of a group are counts, totals and how many values a total is of, so those of several groups or days are
added up. A load writes the days it changes anew, and with them their sums; sums of other days stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.functions.dates import days_between_floor
from backlog.operators.scope import Family, in_study_processes, latest_snapshot_per_status

GROUP = ("study_process", "fuel_types", "pto_study_region")
KEYS = ("status", S.SNAPSHOT, *GROUP)
MEASURES = ("mw_1", "net_mw")
#: What a row of projects is summed up from.
INPUTS = (*KEYS, *MEASURES, "request_receive_date", "queue_date")
Filter = Sequence[str] | None


def sums_of(projects: DataFrame) -> DataFrame:
    """The sums of some projects, which have their status."""
    lead = days_between_floor(F.col("request_receive_date"), F.col("queue_date"))
    totals = {**{m: F.col(m) for m in MEASURES}, "lead": lead.cast("double")}
    return projects.groupBy(*KEYS).agg(
        F.count("*").alias("projects"),
        *[f for name, c in totals.items() for f in (F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n"))],
    )


def replaced(kept: DataFrame, days: DataFrame, anew: DataFrame) -> DataFrame:
    """The sums after a load: those of the (status, day) in `days` go, and `anew` come."""
    of = days.select(F.col("status").alias("_status"), F.col(S.SNAPSHOT).alias("_day")).distinct()
    gone = (F.col("status") == F.col("_status")) & F.col(S.SNAPSHOT).eqNullSafe(F.col("_day"))
    return kept.join(of, gone, "left_anti").unionByName(anew)


def _scope(sums: DataFrame, family: Family, studies: Filter) -> DataFrame:
    return in_study_processes(latest_snapshot_per_status(sums) if family.latest_only else sums, studies)


def _total(measure: str, where: Column | None = None) -> Column:
    """The sum of a measure over rows of sums; null if it is of no value."""
    n, total = F.col(f"{measure}_n"), F.col(f"{measure}_sum")
    if where is not None:
        n, total = F.when(where, n), F.when(where, total)
    return F.when(F.sum(n) > 0, F.sum(total))


def _or_zero(c: Column, family: Family) -> Column:
    return F.coalesce(c, F.lit(0.0)) if family.empty_as_zero else c


def capacity_by_fuel(sums: DataFrame, family: Family, studies: Filter = None) -> DataFrame:
    """A1, A2."""
    active = _scope(sums, family, studies).where(F.col("status") == S.ACTIVE)
    return active.groupBy(F.col("fuel_types").alias("fuel")).agg(_total(family.measure).alias("total_mw"))


def top_zones(sums: DataFrame, family: Family, studies: Filter = None, n: int = 5) -> DataFrame:
    """A5, A6."""
    active = _scope(sums, family, studies).where(F.col("status") == S.ACTIVE)
    totals = active.groupBy(F.col("pto_study_region").alias("iso_zone")).agg(_total(family.measure).alias("total_mw"))
    return totals.orderBy(F.desc_nulls_last("total_mw"), F.asc_nulls_first("iso_zone")).limit(n)


def _by_status(df: DataFrame, measure: str, *more: Column) -> DataFrame:
    """One row: projects and MW of each status."""
    of = {status: F.col("status") == status for status in S.STATUSES}
    return df.agg(
        *[F.coalesce(F.sum(F.when(here, F.col("projects"))), F.lit(0)).alias(f"{status}_count") for status, here in of.items()],
        *[_total(measure, here).alias(f"{status}_mw") for status, here in of.items()],
        *more,
    )


def status_counts(sums: DataFrame, family: Family, studies: Filter = None) -> DataFrame:
    """A3, A4: always three rows."""
    each = [
        F.struct(F.lit(s).alias("status"), F.col(f"{s}_count").alias("project_count"), _or_zero(F.col(f"{s}_mw"), family).alias("total_mw"))
        for s in S.STATUSES
    ]
    return _by_status(_scope(sums, family, studies), family.measure).select(F.inline(F.array(*each)))


def _cancelled(family: Family) -> Column:
    active, completed, withdrawn = (F.coalesce(F.col(f"{s}_mw"), F.lit(0.0)) for s in S.STATUSES)
    return _or_zero(F.try_divide(withdrawn, active + completed + withdrawn), family)


def cancellation_rate(sums: DataFrame, family: Family, studies: Filter = None) -> DataFrame:
    """A7, A8."""
    return _by_status(_scope(sums, family, studies), family.measure).select(_cancelled(family).alias("cancellation_rate"))


def _lead(where: Column) -> Column:
    return F.try_divide(F.sum(F.when(where, F.col("lead_sum"))), F.sum(F.when(where, F.col("lead_n"))))


def lead_time(sums: DataFrame, family: Family, studies: Filter = None) -> DataFrame:
    """A9, A10."""
    average = _or_zero(_lead(F.col("status") == S.ACTIVE), family)
    return _scope(sums, family, studies).agg(average.alias("average_lead_time_days"))


def overview(sums: DataFrame, family: Family, studies: Filter = None) -> DataFrame:
    """The eight headline figures."""
    row = _by_status(_scope(sums, family, studies), family.measure, _lead(F.col("status") == S.ACTIVE).alias("lead"))
    counts = [F.col(f"{s}_count") for s in S.STATUSES]
    mw = [F.coalesce(F.col(f"{s}_mw"), F.lit(0.0)) for s in S.STATUSES]
    return row.select(
        counts[0].alias("active_projects"), mw[0].alias("active_mw"), counts[1].alias("completed_projects"), mw[1].alias("completed_mw"),
        (counts[0] + counts[1] + counts[2]).alias("total_projects"), (mw[0] + mw[1] + mw[2]).alias("total_mw"),
        _cancelled(family).alias("cancellation_rate"), _or_zero(F.col("lead"), family).alias("average_lead_time_days"),
    )


def study_summary(sums: DataFrame, studies: Filter = None) -> DataFrame:
    """A16."""
    known = in_study_processes(sums.where(F.col("study_process").isNotNull()), studies)
    totals = known.groupBy("study_process").agg(F.sum("projects").alias("project_count"), _total("net_mw").alias("total_mw"))
    return totals.orderBy(F.desc("project_count"), "study_process")


def weekly_growth(sums: DataFrame, measure: str = "mw_1") -> DataFrame:
    """A24."""
    per_day = sums.where(F.col(S.SNAPSHOT).isNotNull()).groupBy("status", S.SNAPSHOT).agg(_total(measure).alias("weekly_mw"))
    before = Window.partitionBy("status").orderBy(S.SNAPSHOT)
    return per_day.withColumn("growth_mw", F.col("weekly_mw") - F.lag("weekly_mw").over(before))
