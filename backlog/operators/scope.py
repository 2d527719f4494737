"""Which rows a question is asked of (F1, F4, F12) and the two families of KPIs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.sources.tables import ProjectTables


@dataclass(frozen=True)
class Family:
    """The same KPIs exist twice: for the reports and for the interactive views."""

    measure: str
    latest_only: bool
    empty_as_zero: bool


REPORT = Family(measure="mw_1", latest_only=True, empty_as_zero=False)
INTERACTIVE = Family(measure="net_mw", latest_only=False, empty_as_zero=True)


def latest_snapshot(df: DataFrame) -> DataFrame:
    """F1 within one table. The date is a scalar subquery, so it prunes partitions."""
    newest = df.select(F.max(S.SNAPSHOT)).scalar()
    return df.where(F.col(S.SNAPSHOT) == newest)


def latest_snapshot_per_status(df: DataFrame) -> DataFrame:
    """F1 over the stacked tables: every table has its own newest date.

    The dates come as one small map (three statuses), so this is a plain filter that sinks
    below the joins and prunes partitions, where a join would have to be carried out on top.
    """
    newest = (
        df.where(F.col("status").isin(*S.STATUSES)).groupBy("status").agg(F.max(S.SNAPSHOT).alias("day"))
    )
    days = F.map_from_entries(F.collect_list(F.struct("status", "day")))
    return df.where(F.col(S.SNAPSHOT) == F.try_element_at(newest.select(days).scalar(), F.col("status")))


def in_study_processes(df: DataFrame, study_processes: Sequence[str] | None) -> DataFrame:
    """no list, or an empty one, keeps everything."""
    return df.where(F.col("study_process").isin(*study_processes)) if study_processes else df


def _needed(columns: Sequence[str], family: Family, study_processes) -> list[str]:
    extra = [S.SNAPSHOT] if family.latest_only else []
    extra += ["study_process"] if study_processes else []
    return list(dict.fromkeys([*columns, *extra]))


def projects_of(
    tables: ProjectTables,
    status: str,
    columns: Sequence[str],
    family: Family,
    study_processes: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of one table that the family looks at."""
    df = tables.table(status, _needed(columns, family, study_processes))
    if family.latest_only:
        known = tables.newest_date(status)
        df = latest_snapshot(df) if known is None else df.where(F.col(S.SNAPSHOT) == F.lit(known))
    return in_study_processes(df, study_processes)


def projects_of_all(
    tables: ProjectTables,
    columns: Sequence[str],
    family: Family,
    study_processes: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of all three tables that the family looks at, with `status`."""
    df = tables.all_projects(["status", *_needed(columns, family, study_processes)])
    if family.latest_only:
        known = {status: tables.newest_date(status) for status in S.STATUSES}
        if None in known.values():
            df = latest_snapshot_per_status(df)
        else:  # a constant for each table of the union, so each prunes its partitions
            days = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
            df = df.where(F.col(S.SNAPSHOT) == F.try_element_at(days, F.col("status")))
    return in_study_processes(df, study_processes)
