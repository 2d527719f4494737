"""The registered queries: every operator asked of the star schema's project tables.

Survey ids stand in each group's comment; `backlog.plans.oracle` holds the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.functions.dates import snapshot_date_of
from backlog.functions.labels import study_label, study_order
from backlog.functions.numbers import format_mw, safe_float, safe_int
from backlog.functions.text import contains_any
from backlog.operators import browse, cells, geo, metrics, quality, shape, snapshots, sums, timing
from backlog.operators.scope import (
    INTERACTIVE,
    REPORT,
    latest_snapshot,
    latest_snapshot_per_status,
)
from backlog.operators.search import TextIndex
from backlog.sources import sheets
from backlog.sources import tables as stored
from backlog.sources.bucketed import BucketedTable
from backlog.sources.ranged import RangedTable
from backlog.sources.reports import write_csv
from backlog.sources.star import CLUSTER_LAYOUT, SHEET, StarTables
from backlog.sources.store import StoredTable

Query = Callable[[SparkSession, str], DataFrame]

STUDY_FILTER = ("C01", "C14", "TC")
NO_SUCH_STUDY = ("C99",)
LOAD_DATE = date(2001, 1, 1)
LATE_DATE = date(1998, 1, 1)
BATCH_START = date(1999, 1, 1)
AS_OF = date(2000, 6, 30)
TABLE_KEYS = ("status", S.KEY)
FUELS = ("PROMO", "SMALL")
SEARCH = "customer#0+[1-9]"
SPELLINGS = (
    "san bernadino", " San Clara County", "MOJAVE", "Church County", "Tecate Baja California Mexico", "Rosamond/Kern", "hyder",
)
KEPT_COLUMNS = ("status", "queue_position", "project_name", "net_mw", "ingestion_date")

_REGISTRY: dict[str, Query] = {}


def _register(build: Callable[[StarTables], DataFrame], name: str | None = None):
    _REGISTRY[name or build.__name__] = lambda spark, path: build(StarTables(spark, path))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- sources, shaping (S1-S11, P1-P9, F2) ---------------------------------------------------


@_register
def snapshot_scan(t):
    return shape.shape_snapshot(t.flat_sheets(), F.col(S.SNAPSHOT), t.places())


@_register
def snapshot_files(t):
    """The sheets of all three tables, landed as CSV under their title and header rows, and read again."""
    folder, day = sheets.landing_folder(t.spark, "snapshots"), "Snapshot Date"
    levels, cells = t.raw_sheets()
    cells.write.partitionBy("status").parquet(f"{folder}/cells")  # the star is joined once for all three
    cells, frames = t.spark.read.schema(cells.schema).parquet(f"{folder}/cells"), []
    for status in S.STATUSES:
        own = cells.where(F.col("status") == status).drop("status")
        sheets.write_snapshot(own, [*levels[status], tuple(day.split())], f"{folder}/{status}")
        landed = sheets.read_snapshot(t.spark, f"{folder}/{status}").drop(sheets.FILE_NAME)
        rows = shape.shape_snapshot(landed, F.col(day), t.places()).drop(day)
        frames.append(rows.withColumn("status", F.lit(status)))
    return reduce(lambda a, b: a.unionByName(b), frames)


@_register
def snapshot_ranges(t):
    """The active sheet landed as one file, and read by many tasks, 64 KB each, or more of a very large file."""
    folder, day = sheets.landing_folder(t.spark, "ranges"), "Snapshot Date"
    levels, cells = t.raw_sheet(S.ACTIVE)
    sheets.write_one_file(cells, [*levels, tuple(day.split())], folder)
    landed = sheets.read_snapshot(t.spark, folder, range_bytes=1 << 16).drop(sheets.FILE_NAME)
    return shape.shape_snapshot(landed, F.col(day), t.places()).drop(day)


@_register
def newest_file(t):
    """The rows of the newest file of each sheet, where a file is named by its snapshot's date."""
    name = F.concat(F.lit("queue-report-"), F.date_format(S.SNAPSHOT, "MMddyyyy"), F.lit(".csv"))
    frames = []
    for status in S.STATUSES:
        rows = t.table(status, [S.KEY, "project_name", S.SNAPSHOT, "status"]).withColumn(sheets.FILE_NAME, name)
        frames.append(sheets.newest_file_rows(rows).withColumnRenamed(sheets.FILE_NAME, "file_name"))
    return reduce(lambda a, b: a.unionByName(b), frames)


@_register
def found_place_columns(t):
    """Sheets whose county and state stand under headers that only contain these words."""
    rows = t.all_projects(["status", S.KEY, "county", "state"])
    named = rows.withColumnsRenamed({"county": "Project County", "state": "Project State"})
    located = shape.locate(named, t.places())
    return located.withColumnsRenamed({"Project County": "project_county", "Project State": "project_state"})


@_register
def cluster_files(t):
    """The sheets of the cluster workbook, landed as CSV in files of two layouts, read again and stacked."""
    folder, cells, paths = sheets.landing_folder(t.spark, "cluster"), t.cluster_cells(), {}
    odd = F.pmod(F.xxhash64("Queue Number"), F.lit(2)) == 1
    for name in ("Cluster 15 ", "Withdrawn"):
        unused = [SHEET] if name == "Withdrawn" else [SHEET, "Withdrawal Date"]
        rows = cells.where(F.col(SHEET) == name).drop(*unused)
        paths[name] = [f"{folder}/{name.strip()}/{layout}" for layout in ("forward", "backward")]
        sheets.write_cluster_sheet(rows.where(~odd), paths[name][0])
        sheets.write_cluster_sheet(rows.where(F.coalesce(odd, F.lit(True))).select(*[f"`{c}`" for c in reversed(rows.columns)]), paths[name][1])
    dated = F.trunc(F.to_date("Application Date"), "year")
    landed = sheets.read_cluster(t.spark, paths)
    return shape.shape_cluster(landed, dated, t.places()).drop(sheets.FILE_NAME)


@_register
def header_flatten(t):
    """The headers of each sheet, and how many rows fill them."""
    sheet, rows = t.flat_sheets(), None
    counts = sheet.groupBy("status").agg(*[F.count(f"`{c}`").alias(c) for c in sheet.columns if c not in ("status", S.SNAPSHOT)])
    for status in S.STATUSES:
        own = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(header).alias("header"), F.col(f"`{header}`").alias("filled_rows"))
            for i, header in enumerate(t.sheet_headers(status), start=1)
        ])
        rows = F.when(F.col("status") == status, own) if rows is None else rows.when(F.col("status") == status, own)
    return counts.select("status", F.inline(rows))


@_register
def column_rename(t):
    return shape.rename_columns(t.flat_sheets())


@_register
def drop_blank_key(t):
    kept = shape.drop_blank_keys(t.all_projects(["status", S.KEY, S.SNAPSHOT]))
    return kept.groupBy("status", S.SNAPSHOT).agg(F.count("*").alias("kept_rows"))


@_register
def fuel_types(t):
    single = ["fuel_type_1", "fuel_type_2", "fuel_type_3"]
    rows = shape.with_fuel_types(t.all_projects(single), single)
    return rows.groupBy(*single, "fuel_types").agg(F.count("*").alias("project_count"))


@_register
def cluster_union(t):
    columns = [column for _, column in CLUSTER_LAYOUT]
    return t.cluster([*columns, "withdrawal_date", "application_status", "study_process", S.SNAPSHOT])


@_register
def cluster_projects(t):
    return t.cluster()


@_register
def cluster_display(t):
    return browse.present_columns(t.cluster())


@_register
def active_projects(t):
    return t.table(S.ACTIVE)


@_register
def snapshot_date_parse(t):
    day = F.date_format(S.SNAPSHOT, "MMddyyyy")
    name = (
        F.when(F.col("study_process").isNull(), "queue-report.csv")
        .when(F.col("status") == S.WITHDRAWN, F.concat(F.lit("queue-report-99"), F.substring(day, 3, 6), F.lit(".csv")))
        .otherwise(F.concat(F.lit("queue-report-"), day, F.lit(".csv")))
    )
    files = t.all_projects(["study_process", "status", S.SNAPSHOT]).select(name.alias("file_name"))
    counted = files.groupBy("file_name").agg(F.count("*").alias("row_count"))
    return counted.withColumn("snapshot_date", snapshot_date_of(F.col("file_name")))


@_register
def table_inventory(t):
    return stored.table_inventory(t)


@_register
def table_columns(t):
    return reduce(lambda a, b: a.unionByName(b), [stored.table_columns(t.scan(name), name) for name in t.names()])


@_register
def safe_numeric(t):
    key = F.col("c_custkey")
    text = (
        F.when(key % 5 == 0, F.col("c_acctbal").cast("string"))
        .when(key % 5 == 1, F.concat(F.lit(" "), key.cast("string"), F.lit(" ")))
        .when(key % 5 == 2, F.col("c_name"))
        .when(key % 5 == 3, "")
    )
    balance = F.col("c_acctbal")
    return t.source("customer").select(
        "c_custkey",
        safe_float(text).alias("text_float"),
        safe_float(text, -1.0).alias("text_float_default"),
        safe_int(text, -1).alias("text_int"),
        safe_int(balance).alias("number_int"),
    )


# --- scope (F1, F15, U1, J3, J4, A20, A22, A24) ----------------------------------------------


_register(lambda t: latest_snapshot_per_status(t.all_projects(KEPT_COLUMNS)), "latest_snapshot")


@_register
def latest_active_rows(t):
    return latest_snapshot(t.table(S.ACTIVE, KEPT_COLUMNS))


def _ranged(t):
    rows = t.all_projects(KEPT_COLUMNS)
    return RangedTable(t.spark, sheets.landing_folder(t.spark, "ranged")).write(rows, files=32)


@_register
def latest_rows_ranged(t):
    """The rows of the newest date of all, from a layout by date and MW."""
    return _ranged(t).latest()


@_register
def largest_rows(t):
    """The hundred rows of most MW, from the same layout."""
    return _ranged(t).largest(100, "status", "queue_position", "project_name", S.SNAPSHOT)


@_register
def retention(t):
    kept = snapshots.retain(t.all_projects(["status", S.SNAPSHOT, "net_mw"]), AS_OF)
    return kept.groupBy("status", S.SNAPSHOT).agg(
        F.count("*").alias("kept_rows"), F.sum("net_mw").alias("kept_mw")
    )


def _again(rows):
    """Rows to load, told from the stored ones of the same key and date by their MW."""
    return rows.withColumn("net_mw", F.col("net_mw") + 1)


def _stored_and_at(t, day):
    """Everything as stored, rows of the day, newer and undated ones too; and the day's rows, loaded again."""
    rows = t.all_projects(KEPT_COLUMNS)
    return shape.drop_blank_keys(rows), _again(rows.where(F.col(S.SNAPSHOT) == F.lit(day)))


@_register
def snapshot_upsert(t):
    return snapshots.upsert(*_stored_and_at(t, LOAD_DATE), LOAD_DATE, TABLE_KEYS)


@_register
def snapshot_upsert_late(t):
    return snapshots.upsert(*_stored_and_at(t, LATE_DATE), LATE_DATE, TABLE_KEYS)


@_register
def snapshot_upsert_batch(t):
    rows = t.all_projects(KEPT_COLUMNS)
    incoming = _again(rows.where(F.col(S.SNAPSHOT) >= F.lit(BATCH_START)))
    return snapshots.upsert_dated(shape.drop_blank_keys(rows), incoming, TABLE_KEYS)


@_register
def superseded_rows(t):
    gone = snapshots.superseded(*_stored_and_at(t, LOAD_DATE), TABLE_KEYS)
    return gone.groupBy("status", S.SNAPSHOT).agg(F.count("*").alias("superseded_rows"))


@_register
def load_counts(t):
    return snapshots.load_counts(*_stored_and_at(t, LOAD_DATE), LOAD_DATE, TABLE_KEYS)


@_register
def snapshot_upsert_bucketed(t):
    """The same as `snapshot_upsert`, into a table whose files are dealt by key."""
    rows, incoming = _stored_and_at(t, LOAD_DATE)
    return _bucketed(t, rows).upsert(incoming, LOAD_DATE)


def _bucketed(t, rows):
    folder = sheets.landing_folder(t.spark, "bucketed")
    return BucketedTable(t.spark, f"stored_{folder[-32:]}", TABLE_KEYS, buckets=16).write(rows, folder)


@_register
def load_counts_observed(t):
    """What became of the rows of a load into each stored table, as the jobs that wrote them counted."""
    folder, out = sheets.landing_folder(t.spark, "observed"), []
    for status, name in S.TABLE_OF_STATUS.items():
        rows = t.table(status, KEPT_COLUMNS).drop("status").withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")})
        table = StoredTable(t.spark, folder, name, rows.schema)
        table.replace(shape.drop_blank_keys(rows))
        n = table.load_counted(_again(rows.where(F.col(S.SNAPSHOT) == F.lit(LOAD_DATE))), LOAD_DATE)
        out.append((name, n.rows_read, n.rows_dropped, n.rows_written, n.rows_replaced, n.rows_superseded))
    return t.spark.createDataFrame(out, "table_name string, rows_read long, rows_dropped long, rows_written long, rows_replaced long, rows_superseded long")


@_register
def raw_header_load(t):
    """Withdrawn projects stored under a raw header, then a load under the column's name."""
    rows = shape.drop_blank_keys(t.table(S.WITHDRAWN, [c for c in KEPT_COLUMNS if c != "status"]))
    rows = rows.withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")})
    table = StoredTable(t.spark, sheets.landing_folder(t.spark, "headers"), "withdrawn_projects", rows.schema)
    table.replace(rows.withColumnRenamed("project_name", "Unnamed: 0_level_0 Project Name - Confidential"))
    table.load(_again(rows.where(F.col(S.SNAPSHOT) == F.lit(LOAD_DATE))), LOAD_DATE)
    return table.read().select(S.KEY, "project_name", "net_mw", S.SNAPSHOT)


@_register
def duplicate_keys_per_table(t):
    """The ten keys stored most often in each table."""
    counts = shape.drop_blank_keys(t.all_projects(list(TABLE_KEYS))).groupBy(*TABLE_KEYS).agg(F.count("*").alias("count"))
    place = F.row_number().over(Window.partitionBy("status").orderBy(F.desc("count"), S.KEY))
    return counts.where("count > 1").withColumn("position", place).where("position <= 10")


@_register
def duplicate_keys(t):
    return snapshots.duplicate_keys(shape.drop_blank_keys(t.all_projects(list(TABLE_KEYS))), TABLE_KEYS)


@_register
def weekly_growth(t):
    return metrics.weekly_growth(t)


# --- report KPIs (A1, A3, A5, A7, A9, A11, A13) ----------------------------------------------

_register(lambda t: metrics.capacity_by_fuel(t, REPORT), "capacity_by_fuel")
_register(lambda t: metrics.status_counts(t, REPORT), "status_counts")
_register(lambda t: metrics.top_zones(t, REPORT), "top_zones")
_register(lambda t: metrics.cancellation_rate(t, REPORT), "cancellation_rate")
_register(lambda t: timing.lead_time(t, REPORT), "lead_time")
_register(lambda t: metrics.top_projects(t, REPORT), "top_projects")
_register(lambda t: timing.delay_detail(t, REPORT), "delay_detail")
_register(lambda t: timing.delay_summary(t, REPORT), "delay_summary")
_register(lambda t: timing.delay_by_fuel(t, REPORT), "delay_by_fuel")

# --- interactive KPIs (A2, A4, A6, A8, A10, A12, A13d, A15-A19, A25) -------------------------

_DASH = {
    "dash_capacity_by_fuel": lambda t, f: metrics.capacity_by_fuel(t, INTERACTIVE, f),
    "dash_status_counts": lambda t, f: metrics.status_counts(t, INTERACTIVE, f),
    "dash_top_zones": lambda t, f: metrics.top_zones(t, INTERACTIVE, f),
    "dash_cancellation_rate": lambda t, f: metrics.cancellation_rate(t, INTERACTIVE, f),
    "dash_lead_time": lambda t, f: timing.lead_time(t, INTERACTIVE, f),
    "dash_top_projects": lambda t, f: metrics.top_projects(t, INTERACTIVE, f),
    "dash_delay_by_fuel": lambda t, f: timing.late_by_fuel(t, f),
    "lead_time_bands": lambda t, f: timing.lead_time_bands(t, INTERACTIVE, f),
    "overview": lambda t, f: metrics.overview(t, INTERACTIVE, f),
    "study_summary": lambda t, f: metrics.study_summary(t, f),
    "all_projects": lambda t, f: browse.projects(t, "all", None, f),
}
for _name, _build in _DASH.items():
    _register(lambda t, b=_build: b(t, None), _name)
    _register(lambda t, b=_build: b(t, STUDY_FILTER), f"{_name}_filtered")
for _name in ("dash_status_counts", "dash_cancellation_rate", "dash_lead_time", "overview"):
    _register(lambda t, b=_DASH[_name]: b(t, NO_SUCH_STUDY), f"{_name}_empty")

_register(metrics.study_processes, "study_processes")
_register(metrics.cluster_summary, "cluster_summary")
_register(metrics.cluster_capacity_by_fuel, "cluster_capacity_by_fuel")
_register(metrics.latest_ingestion, "latest_ingestion")
_register(metrics.latest_ingestion_label, "latest_ingestion_label")


@_register
def study_labels(t):
    label = study_label(F.col("study_process")).alias("label")
    return metrics.study_processes(t).select("study_process", label)


@_register
def capacity_labels(t):
    totals = metrics.capacity_by_fuel(t, INTERACTIVE)
    return totals.withColumn("label", format_mw(F.col("total_mw")))


# --- the same from sums kept per snapshot (A1-A8, A10, A15, A16, A24) ------------------------


def _kept_sums(t):
    """The sums of all projects, stored by day and read again."""
    folder = sheets.landing_folder(t.spark, "sums")
    made = sums.sums_of(t.all_projects(list(sums.INPUTS)))
    made.write.partitionBy(S.SNAPSHOT).parquet(folder)
    return t.spark.read.schema(made.schema).parquet(folder).select(*made.columns)


_KEPT = {
    "capacity_by_fuel": lambda k: sums.capacity_by_fuel(k, REPORT),
    "status_counts": lambda k: sums.status_counts(k, REPORT),
    "weekly_growth": lambda k: sums.weekly_growth(k),
    "dash_top_zones": lambda k: sums.top_zones(k, INTERACTIVE),
    "overview": lambda k: sums.overview(k, INTERACTIVE),
    "study_summary_filtered": lambda k: sums.study_summary(k, STUDY_FILTER),
}
for _name, _build in _KEPT.items():
    _register(lambda t, b=_build: b(_kept_sums(t)), f"kept_{_name}")


@_register
def kept_sums_after_load(t):
    """The sums after a load: of the days it changed they are made anew, those of other days stay."""
    columns = list(dict.fromkeys([*KEPT_COLUMNS, *sums.INPUTS]))
    rows = t.all_projects(columns)
    before, incoming = shape.drop_blank_keys(rows), _again(rows.where(F.col(S.SNAPSHOT) == F.lit(LOAD_DATE)))
    gone = snapshots.superseded(before, incoming, TABLE_KEYS)
    days = gone.select("status", S.SNAPSHOT).unionByName(incoming.select("status", S.SNAPSHOT)).distinct()
    of = days.select(F.col("status").alias("_status"), F.col(S.SNAPSHOT).alias("_day"))
    after = snapshots.upsert(before, incoming, LOAD_DATE, TABLE_KEYS)
    changed = after.join(of, (F.col("status") == F.col("_status")) & (F.col(S.SNAPSHOT) == F.col("_day")), "left_semi")
    kept = sums.replaced(sums.sums_of(before), days, sums.sums_of(changed))
    return kept.groupBy("status", S.SNAPSHOT, "study_process").agg(F.sum("projects").alias("project_count"), F.sum("net_mw_sum").alias("total_mw"))


# --- browsing (B1-B3, F5-F9, D3, D4, A14, A23) -----------------------------------------------


@_register
def projects_columns(t):
    columns = ["project_name", "queue_position", "net_mw", "ingestion_date"]
    return browse.projects(t, "all", columns, STUDY_FILTER)


@_register
def withdrawn_columns(t):
    return browse.projects(t, "withdrawn", ["queue_position", "study_process", "mw_1"], STUDY_FILTER)


@_register
def browse_table(t):
    df = browse.projects(t, "all", browse.TABLE_COLUMNS)
    return browse.present_columns(df, browse.TABLE_COLUMNS)


@_register
def fuel_contains_any(t):
    totals = metrics.capacity_by_fuel(t, INTERACTIVE)
    return totals.where(contains_any(F.col("fuel"), FUELS)).orderBy(F.desc("total_mw"), "fuel")


_BROWSE_COLUMNS = ["project_name", "queue_position", "county", "state", "fuel_types", "net_mw"]


def _browsed(t):
    df = browse.projects(t, "all", _BROWSE_COLUMNS)
    return browse.filter_projects(
        df, fuels=FUELS, states=("ASIA", "EUROPE"), min_capacity=50.0, search=SEARCH
    )


_register(_browsed, "browse_projects")
_register(lambda t: browse.browse_metrics(_browsed(t)), "browse_metrics")


@_register
def browse_counties(t):
    df = browse.projects(t, "active", _BROWSE_COLUMNS)
    return browse.filter_projects(df, counties=("NATION_1", "NATION_7", "NOWHERE"), min_capacity=10.0)


@_register
def name_search(t):
    df = t.all_projects(["status", "project_name", "queue_position"])
    return browse.filter_projects(df, search="R#0+[12]")


def _indexed(t, rows, column):
    return TextIndex(t.spark, sheets.landing_folder(t.spark, "index"), column).write(rows)


@_register
def name_search_indexed(t):
    """The same as `name_search`, by trigrams."""
    return _indexed(t, t.all_projects(["status", "project_name", "queue_position"]), "project_name").search("R#0+[12]")


@_register
def browse_projects_indexed(t):
    """The same as `browse_projects`: fuels by trigrams, then the other filters."""
    found = _indexed(t, browse.projects(t, "all", _BROWSE_COLUMNS), "fuel_types").containing(FUELS)
    return browse.filter_projects(found, states=("ASIA", "EUROPE"), min_capacity=50.0, search=SEARCH).select(*_BROWSE_COLUMNS, "status")


@_register
def csv_export(t):
    """The browse result written as CSV and read again."""
    folder, found = sheets.landing_folder(t.spark, "export"), _browsed(t)
    write_csv(found, folder)
    return t.spark.read.schema(found.schema).option("header", True).csv(folder)


@_register
def fuel_categories(t):
    return browse.fuel_categories(t.all_projects(["fuel_types"]))


@_register
def fuel_categories_late(t):
    return browse.fuel_categories(timing.late_by_fuel(t), "fuel", strip=True)


@_register
def state_options(t):
    return browse.options(t.all_projects(["state"]), "state")


@_register
def county_state_options(t):
    return browse.county_state_options(t.all_projects(["county", "state"]))


@_register
def project_locations(t):
    return browse.project_locations(t)


@_register
def project_locations_withdrawn(t):
    return browse.project_locations(t, "withdrawn")


@_register
def location_rollup(t):
    return browse.location_rollup(browse.project_locations(t))


@_register
def zoom_cells(t):
    return cells.zoom_rollup(browse.project_locations(t)).select("level", "cell", "places", "project_count", "total_capacity")


# --- orders of output (T4-T6) ----------------------------------------------------------------


def _placed(df, *order):
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)))  # over results that are small by nature


@_register
def ordered_study_processes(t):
    return _placed(metrics.study_processes(t), *study_order(F.col("study_process")))


@_register
def ordered_top_projects(t):
    order = (F.desc("net_mw"), F.asc_nulls_first("project_name"), F.asc_nulls_first(S.KEY))
    return _placed(metrics.top_projects(t, REPORT).select("project_name", S.KEY, "net_mw"), *order)


@_register
def ordered_options(t):
    """The option lists as they are shown, each from 1."""
    shown = browse.county_state_options(t.all_projects(["county", "state"]))
    return shown.withColumn("position", F.row_number().over(Window.partitionBy("field").orderBy("value")))


# --- places (J1, J2, A21) and quality (A26) --------------------------------------------------


@_register
def county_centroid(t):
    return geo.centroids_of_pairs(t.all_projects(["county", "state"]), t.centroids(), "county", "state")


@_register
def geo_enrich(t):
    rows = t.all_projects(["status", "queue_position", "county", "state"])
    return geo.with_coordinates(rows, t.places())


@_register
def places_off_the_globe(t):
    far = t.centroids().withColumns({"lat": (F.col("lat") - 30) * 10, "lon": (F.col("lon") + 120) * 16})
    return geo.centroids_of_pairs(t.all_projects(["county", "state"]), far, "county", "state")


@_register
def county_spelling(t):
    spellings = F.array(*[F.lit(text) for text in SPELLINGS])
    county = F.get(spellings, F.pmod("c_custkey", F.lit(len(SPELLINGS))).cast("int"))
    rows = t.source("customer").select(county.alias("county"), F.lit("CA").alias("state"))
    return geo.with_coordinates(rows).groupBy("county", "latitude", "longitude").agg(F.count("*").alias("project_count"))


@_register
def coordinate_coverage(t):
    return geo.coordinate_coverage(t.all_projects(["latitude"]))


@_register
def data_quality(t):
    return quality.data_quality(t)


@_register
def data_quality_total(t):
    return quality.issue_total(quality.data_quality(t))


@_register
def data_quality_failing(t):
    """No table of completed projects, an empty one of withdrawn projects without MW and dates, active ones without names."""
    withdrawn = t.table(S.WITHDRAWN).where("net_mw < 0")
    broken = stored.ProjectTables(t.spark, {
        S.TABLE_OF_STATUS[S.ACTIVE]: t.table(S.ACTIVE).drop("project_name"),
        S.TABLE_OF_STATUS[S.WITHDRAWN]: withdrawn.drop("mw_1", S.SNAPSHOT),
    })
    return quality.data_quality(broken)
