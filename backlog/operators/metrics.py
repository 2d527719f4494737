"""Capacity, counts, rates, top lists.

One implementation serves the report and the interactive family; the family says which measure
is summed, which rows count and whether nothing reads as null or as zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.functions.dates import days_between_floor
from backlog.functions.labels import cluster_number, study_order
from backlog.functions.text import clean_text, is_filled
from backlog.operators.scope import Family, in_study_processes, projects_of, projects_of_all
from backlog.sources.tables import ProjectTables

Filter = Sequence[str] | None


def _sum_by(df: DataFrame, key: str, name: str, measure: str) -> DataFrame:
    return df.groupBy(F.col(key).alias(name)).agg(F.sum(measure).alias("total_mw"))


def _or_zero(c: Column, family: Family) -> Column:
    return F.coalesce(c, F.lit(0.0)) if family.empty_as_zero else c


def capacity_by_fuel(tables: ProjectTables, family: Family, study_processes: Filter = None) -> DataFrame:
    """A1, A2: MW of the active projects per whole fuel string."""
    df = projects_of(tables, S.ACTIVE, ["fuel_types", family.measure], family, study_processes)
    return _sum_by(df, "fuel_types", "fuel", family.measure)


def top_zones(
    tables: ProjectTables, family: Family, study_processes: Filter = None, n: int = 5
) -> DataFrame:
    """The n study regions with most active MW."""
    df = projects_of(tables, S.ACTIVE, ["pto_study_region", family.measure], family, study_processes)
    totals = _sum_by(df, "pto_study_region", "iso_zone", family.measure)
    return totals.orderBy(F.desc_nulls_last("total_mw"), F.asc_nulls_first("iso_zone")).limit(n)


def _status_totals(df: DataFrame, measure: str, extra: Sequence[Column] = ()) -> DataFrame:
    """One row with count and MW of every status, in one pass; absent statuses count 0, sum null."""
    aggregates = []
    for status in S.STATUSES:
        of_status = F.col("status") == status
        aggregates += [
            F.count_if(of_status).alias(f"{status}_count"),
            F.sum(F.when(of_status, F.col(measure))).alias(f"{status}_mw"),
        ]
    return df.agg(*aggregates, *extra)


def status_counts(tables: ProjectTables, family: Family, study_processes: Filter = None) -> DataFrame:
    """A3, A4: projects and MW per status; always three rows."""
    df = projects_of_all(tables, [family.measure], family, study_processes)
    rows = F.array(*[
        F.struct(
            F.lit(status).alias("status"),
            F.col(f"{status}_count").alias("project_count"),
            _or_zero(F.col(f"{status}_mw"), family).alias("total_mw"),
        )
        for status in S.STATUSES
    ])
    return _status_totals(df, family.measure).select(F.inline(rows))


def _cancelled_share(family: Family) -> Column:
    active, completed, withdrawn = (
        F.coalesce(F.col(f"{status}_mw"), F.lit(0.0)) for status in S.STATUSES
    )
    return _or_zero(F.try_divide(withdrawn, active + completed + withdrawn), family)


def cancellation_rate(
    tables: ProjectTables, family: Family, study_processes: Filter = None
) -> DataFrame:
    """Withdrawn MW over all MW."""
    df = projects_of_all(tables, [family.measure], family, study_processes)
    totals = _status_totals(df, family.measure)
    return totals.select(_cancelled_share(family).alias("cancellation_rate"))


def overview(tables: ProjectTables, family: Family, study_processes: Filter = None) -> DataFrame:
    """The eight headline figures, from one pass over the projects."""
    columns = [family.measure, "request_receive_date", "queue_date"]
    df = projects_of_all(tables, columns, family, study_processes)
    lead = F.when(
        F.col("status") == S.ACTIVE,
        days_between_floor(F.col("request_receive_date"), F.col("queue_date")),
    )
    totals = _status_totals(df, family.measure, [F.avg(lead).alias("lead")])
    counts = [F.col(f"{s}_count") for s in S.STATUSES]
    sums = [F.coalesce(F.col(f"{s}_mw"), F.lit(0.0)) for s in S.STATUSES]
    return totals.select(
        counts[0].alias("active_projects"),
        sums[0].alias("active_mw"),
        counts[1].alias("completed_projects"),
        sums[1].alias("completed_mw"),
        (counts[0] + counts[1] + counts[2]).alias("total_projects"),
        (sums[0] + sums[1] + sums[2]).alias("total_mw"),
        _cancelled_share(family).alias("cancellation_rate"),
        _or_zero(F.col("lead"), family).alias("average_lead_time_days"),
    )


def top_projects(
    tables: ProjectTables, family: Family, study_processes: Filter = None, n: int = 10
) -> DataFrame:
    """The n largest projects; a project shows the row that holds its largest MW.

    `row_number() = 1` keeps one row per project already before the shuffle (a group limit),
    so a project with very many rows does not load one task.
    """
    payload = ["net_mw", "fuel_types", "county", "state"]
    if family.empty_as_zero:
        payload.insert(2, "study_process")
    columns = ["project_name", S.KEY, *payload]
    df = projects_of(tables, S.ACTIVE, columns, family, study_processes).select(*columns)
    best = Window.partitionBy("project_name", S.KEY).orderBy(
        F.desc("net_mw"), *[F.asc_nulls_first(c) for c in payload[1:]]
    )
    return (
        df.where(F.col("net_mw").isNotNull())
        .withColumn("_rank", F.row_number().over(best))
        .where("_rank = 1")
        .drop("_rank")
        .withColumn("status", F.lit(S.ACTIVE))
        .orderBy(F.desc("net_mw"), F.asc_nulls_first("project_name"), F.asc_nulls_first(S.KEY))
        .limit(n)
    )


def study_summary(tables: ProjectTables, study_processes: Filter = None) -> DataFrame:
    """Projects and MW per study process over all tables, most projects first."""
    df = tables.all_projects(["study_process", "net_mw"]).where(F.col("study_process").isNotNull())
    return (
        in_study_processes(df, study_processes)
        .groupBy("study_process")
        .agg(F.count("*").alias("project_count"), F.sum("net_mw").alias("total_mw"))
        .orderBy(F.desc("project_count"), "study_process")
    )


def study_processes(tables: ProjectTables) -> DataFrame:
    """The processes in use, and the next cluster once the data reaches its predecessor."""
    used = (
        tables.all_projects(["study_process"])
        .where(is_filled(F.col("study_process")))
        .select(clean_text(F.col("study_process")).alias("process"))
        .distinct()
    )
    following = F.when(cluster_number(F.col("process")) >= 14, S.CLUSTER_PROCESS)
    offered = F.array_compact(F.array("process", following))
    each = used.select(F.explode(offered).alias("study_process"))
    return each.distinct().orderBy(*study_order(F.col("study_process")))


def cluster_summary(tables: ProjectTables) -> DataFrame:
    """Cluster requests and their MW."""
    return tables.cluster(["net_mw"]).agg(
        F.count("*").alias("total_projects"),
        F.coalesce(F.sum("net_mw"), F.lit(0.0)).alias("total_mw"),
    )


def cluster_capacity_by_fuel(tables: ProjectTables) -> DataFrame:
    """Cluster MW per fuel string, largest first."""
    totals = _sum_by(tables.cluster(["fuel_types", "net_mw"]), "fuel_types", "fuel", "net_mw")
    return totals.orderBy(F.desc_nulls_last("total_mw"), "fuel")


def latest_ingestion(tables: ProjectTables) -> DataFrame:
    """The newest snapshot date over all tables; null when there is none."""
    newest = [
        tables.all_projects([S.SNAPSHOT]).agg(F.max(S.SNAPSHOT).alias("latest_ingestion_date")),
        tables.cluster([S.SNAPSHOT]).agg(F.max(S.SNAPSHOT).alias("latest_ingestion_date")),
    ]
    both = newest[0].unionByName(newest[1])
    return both.agg(F.max("latest_ingestion_date").alias("latest_ingestion_date"))


def latest_ingestion_label(tables: ProjectTables) -> DataFrame:
    """A19 as shown: `June 02, 2025`, or that there is none."""
    text = F.date_format("latest_ingestion_date", "MMMM dd, yyyy")
    return latest_ingestion(tables).select(F.coalesce(text, F.lit("Unavailable")).alias("data_as_of"))


def weekly_growth(tables: ProjectTables, measure: str = "mw_1") -> DataFrame:
    """MW per status and snapshot, and the change since the snapshot before."""
    per_snapshot = (
        tables.all_projects(["status", S.SNAPSHOT, measure])
        .where(F.col(S.SNAPSHOT).isNotNull())
        .groupBy("status", S.SNAPSHOT)
        .agg(F.sum(measure).alias("weekly_mw"))
    )
    before = Window.partitionBy("status").orderBy(S.SNAPSHOT)
    return per_snapshot.withColumn(
        "growth_mw", F.col("weekly_mw") - F.lag("weekly_mw").over(before)
    )
