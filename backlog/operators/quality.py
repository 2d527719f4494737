"""Data-quality report (A26): one row per check, passed or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.sources.tables import ProjectTables

KEY_COLUMNS = (S.KEY, S.SNAPSHOT, "mw_1")
FILLED_COLUMNS = (S.KEY, "project_name")

REPORT_SCHEMA = (
    "table_name string, check_name string, column_name string,"
    " issue_count bigint, pct double, failed boolean"
)


def _row(table: str, check: str, column: str, issues: Column, pct: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        issues.cast("bigint").alias("issue_count"),
        pct.cast("double").alias("pct"),
        failed.alias("failed"),
    )


def _schema_checks(tables: ProjectTables) -> DataFrame:
    """V1-V3 from the catalog alone."""
    rows = []
    for table in S.TABLE_OF_STATUS.values():
        missing = table not in tables.names()
        rows.append((table, "missing_table", "", int(missing), None, missing))
        if not missing:
            present = tables.columns(table)
            rows += [
                (table, "missing_column", c, int(c not in present), None, c not in present)
                for c in (*KEY_COLUMNS, "project_name")
            ]
    return tables.spark.createDataFrame(rows, REPORT_SCHEMA)


def _value_checks(tables: ProjectTables) -> DataFrame | None:
    """V4-V6: the empty cells of all tables, counted in one pass over them."""
    existing = {s: tables.columns(t) for s, t in S.TABLE_OF_STATUS.items() if t in tables.names()}
    used = [c for c in FILLED_COLUMNS if any(c in columns for columns in existing.values())]
    if not existing:
        return None
    aggregates, rows, shown = [], [], []
    for status, columns in existing.items():
        here, total = F.col("status") == status, F.col(f"{status}_rows")
        table = S.TABLE_OF_STATUS[status]
        aggregates.append(F.count_if(here).alias(f"{status}_rows"))
        rows.append(_row(table, "empty_table", "", F.lit(0), F.lit(None), F.lit(False)))
        shown.append(total == 0)
        for c in (c for c in used if c in columns):
            empty = F.col(c).isNull() | (F.col(c) == "")
            aggregates.append(F.count_if(here & empty).alias(f"{status}_{c}"))
            n = F.col(f"{status}_{c}")
            rows.append(_row(table, "empty_value", c, n, F.try_divide(n, total) * 100, n > 0))
            shown.append(total > 0)
    counted = tables.all_projects(["status", *used]).agg(*aggregates)
    kept = F.array_compact(F.array(*[F.when(when, row) for when, row in zip(shown, rows)]))
    return counted.select(F.inline(kept))


def data_quality(tables: ProjectTables) -> DataFrame:
    """V1-V6. A missing table is one failed check; an empty one is noted and passes."""
    values = _value_checks(tables)
    checks = _schema_checks(tables)
    return checks if values is None else checks.unionByName(values)


def issue_total(report: DataFrame) -> DataFrame:
    """V7: the number of failed checks, not of bad rows."""
    return report.agg(F.count_if("failed").alias("issues"))
