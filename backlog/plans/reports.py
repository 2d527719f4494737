"""The weekly jobs: load a snapshot into the store, and write the KPI reports."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from backlog import schema as S
from backlog.operators import metrics, timing
from backlog.operators.scope import REPORT
from backlog.operators.shape import shape_cluster, shape_snapshot
from backlog.sources.reports import write_csv
from backlog.sources.store import StoredTables, incoming_rows
from backlog.sources.tables import ProjectTables

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    """What became of one step; one that fails does not stop the others."""

    name: str
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


def _isolated(name: str, step: Callable[[], object]) -> Outcome:
    try:
        step()
        return Outcome(name)
    except Exception as error:  # noqa: BLE001 - reported, and the other steps still run
        log.exception("%s failed", name)
        return Outcome(name, str(error))


def write_reports(tables: ProjectTables, folder: str) -> list[Outcome]:
    """The nine report files of the seven analyses, each in a folder of its own name."""

    def small(name: str, df: DataFrame, *order: str) -> None:
        write_csv(df, f"{folder}/{name}", single_file=True, order=order)

    def sorted_rows(name: str, df: DataFrame, *order: str) -> None:
        """In as many files as it takes, sorted through all of them: the rows grow with the fuel texts."""
        write_csv(df.orderBy(*order), f"{folder}/{name}")

    def delays() -> None:
        # Worked out once; kept in the executors, and again where one of them is lost.
        detail = timing.delay_detail(tables, REPORT).persist()
        try:
            if detail.isEmpty():
                log.info("no project has both online dates")
                return
            # One row per project: written in as many files as it takes.
            write_csv(detail, f"{folder}/project_timeline_delays")
            small("timeline_delay_summary", timing.summary_of(detail))
            sorted_rows("timeline_delay_by_fuel", timing.by_fuel_of(detail), "fuel_type")
        finally:
            detail.unpersist()

    analyses: dict[str, Callable[[], object]] = {
        "capacity_by_fuel": lambda: sorted_rows(
            "capacity_by_fuel", metrics.capacity_by_fuel(tables, REPORT), "fuel"
        ),
        "project_count_by_status": lambda: small(
            "project_count_by_status", metrics.status_counts(tables, REPORT)
        ),
        "top5_iso_zones": lambda: small("top5_iso_zones", metrics.top_zones(tables, REPORT)),
        "cancellation_rate": lambda: small("cancellation_rate", metrics.cancellation_rate(tables, REPORT)),
        "average_lead_time": lambda: small("average_lead_time", timing.lead_time(tables, REPORT)),
        "top_projects_by_net_mw": lambda: small(
            "top_projects_by_net_mw", metrics.top_projects(tables, REPORT)
        ),
        "timeline_delay_analysis": delays,
    }
    return [_isolated(name, run) for name, run in analyses.items()]


def load_snapshot(store: StoredTables, sheets: dict[str, DataFrame], snapshot_date: date) -> list[Outcome]:
    """Load the status sheets of one snapshot, by status; each on its own."""
    return [
        _isolated(
            S.TABLE_OF_STATUS[status],
            lambda s=status, df=df: store.stored[S.TABLE_OF_STATUS[s]].load(
                incoming_rows(shape_snapshot(df, snapshot_date)), snapshot_date
            ),
        )
        for status, df in sheets.items()
    ]


def load_cluster(store: StoredTables, sheets: dict[str, DataFrame], snapshot_date: date) -> Outcome:
    """Load the cluster workbook's sheets of one date."""

    def load() -> None:
        rows = incoming_rows(shape_cluster(sheets, snapshot_date), S.CLUSTER_SCHEMA)
        store.stored[S.CLUSTER_TABLE].load(rows, snapshot_date)

    return _isolated(S.CLUSTER_TABLE, load)
