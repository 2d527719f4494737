import csv
from datetime import date

import pytest
from helpers import DAY, at, rows
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.operators import shape
from backlog.sources import sheets

TOP = ["", "", "", "", "Generating Facility", "", "MWs", "", "Location", ""]
LOW = [
    "Project Name", "Queue Position", "Interconnection Request\nReceive Date", "Queue Date", "Fuel-1", "Fuel-2",
    "MW-1", "Net MWs to Grid", "County", "State",
]
NAMES = [
    "Unnamed: 0_level_0 Project Name", "Unnamed: 1_level_0 Queue Position",
    "Unnamed: 2_level_0 Interconnection Request\nReceive Date", "Unnamed: 3_level_0 Queue Date",
    "Generating Facility Fuel-1", "Generating Facility Fuel-2", "MWs MW-1", "MWs Net MWs to Grid",
    "Location County", "Location State",
]


def write_sheet(path, records, title="All projects"):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow([title])
        out.writerow([])
        out.writerow([f"as of {path.name}"] + [""] * 9)
        out.writerow(TOP)
        out.writerow(LOW)
        out.writerows(records)


def write_plain_sheet(path, header, records):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(records)


def test_header_levels():
    levels = shape.name_header_levels([TOP, LOW])
    assert levels[0] == ("Unnamed: 0_level_0", "Project Name")
    assert levels[5] == ("Generating Facility", "Fuel-2")
    assert shape.flatten_columns(levels) == NAMES
    assert shape.flatten_columns([("A", ""), ("", "B "), ("C",)]) == ["A", "B", "C"]
    assert shape.name_header_levels([["", None]]) == [("Unnamed: 0_level_0",), ("Unnamed: 1_level_0",)]


def test_rename_keeps_unknown_columns(spark):
    df = spark.createDataFrame([], "`Location County` string, `Extra` string, `MWs MW-1` string")
    assert shape.rename_columns(df).columns == ["county", "Extra", "mw_1"]
    withdrawn = spark.createDataFrame(
        [], "`Unnamed: 0_level_0 Project Name - Confidential` string, `Unnamed: 6_level_0 Study\nProcess` string"
    )
    assert shape.rename_columns(withdrawn).columns == ["project_name", "study_process"]


def test_header_maps_cover_the_schema():
    assert len(S.CLUSTER_HEADERS) == 26
    assert len(set(S.HEADERS.values())) == 35
    assert len(S.PROJECT_SCHEMA) == 37


def test_columns_containing(spark):
    df = spark.createDataFrame([], "`Project Name` string, FUEL string, x string")
    assert shape.columns_containing(df, "name") == ["Project Name"]
    assert shape.columns_containing(df, "fuel") == ["FUEL"]


@pytest.fixture(scope="module")
def sheet_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("sheets")
    write_sheet(folder / "queue-report-01062025.csv", [
        ["Solar Farm A", "1001.0", "2024-04-01", "2024-05-01 07:00:00", "Solar", "", "100.5", "100", "Kern", "CA"],
        ["Wind, Park \"B\"\nII", "Z002", "", "bad date", "Wind", "Battery", "n/a", "200", "KERN/RIVERSIDE", "CA"],
        ["", " ", "", "", "", "", "", "", "", ""],
        ["No key", "", "", "", "Solar", "", "1", "1", "Kern", "CA"],
    ])
    write_sheet(folder / "queue-report-01132025.csv", [
        ["Solar Farm A", "1001", "2024-04-01", "2024-05-01", "Solar", "", "110", "110", "Kern", "CA"],
    ], title="Another title")
    return folder


def test_read_snapshot(spark, sheet_folder):
    raw = sheets.read_snapshot(spark, str(sheet_folder / "queue-report-01062025.csv"))
    assert raw.columns == [*NAMES, "_file_name"]
    assert [r[1] for r in rows(raw)] == ["1001.0", "Z002", " ", None]


def test_bulk_scan_dates_rows_by_file(spark, sheet_folder):
    raw = sheets.read_snapshot(spark, f"{sheet_folder}/*.csv")
    shaped = shape.drop_blank_keys(shape.shape_snapshot(raw, sheets.file_date()))
    got = rows(shaped.select("queue_position", "ingestion_date", "mw_1").orderBy("ingestion_date", "queue_position"))
    assert got == [
        ("1001", date(2025, 1, 6), 100.5), ("Z002", date(2025, 1, 6), None), ("1001", date(2025, 1, 13), 110.0),
    ]
    newest = sheets.newest_file_rows(raw)
    assert [r[1] for r in rows(newest)] == ["1001"]


def test_shape_snapshot(spark, sheet_folder):
    raw = sheets.read_snapshot(spark, str(sheet_folder / "queue-report-01062025.csv")).drop("_file_name")
    shaped = shape.shape_snapshot(raw, DAY)
    first, second = rows(
        shape.drop_blank_keys(shaped)
        .select("project_name", "queue_date", "fuel_types", "mw_1", "net_mw", "latitude", "ingestion_date")
        .orderBy("net_mw")
    )
    assert first == ("Solar Farm A", at("2024-05-01 07:00:00"), "Solar", 100.5, 100.0, 35.3425, DAY)
    assert second == ("Wind, Park \"B\"\nII", None, "Wind/Battery", None, 200.0, pytest.approx(34.64795), DAY)


def test_shape_snapshot_without_fuel_or_place(spark):
    raw = spark.createDataFrame([("Z1",)], "`Unnamed: 1_level_0 Queue Position` string")
    got = shape.shape_snapshot(raw, DAY).select("queue_position", "fuel_types", "latitude", "longitude")
    assert rows(got) == [("Z1", "", None, None)]


def test_drop_blank_keys(spark):
    df = spark.createDataFrame([("Z1",), (" \t",), ("",), (None,)], "queue_position string")
    assert rows(shape.drop_blank_keys(df)) == [("Z1",)]
    other = spark.createDataFrame([("",)], "x string")
    assert shape.drop_blank_keys(other).count() == 1


def test_landed_parquet(spark, tmp_path):
    raw = spark.createDataFrame([("A", "7", 5)], "`Unnamed: 0_level_0 Project Name` string, "
                                "`Unnamed: 1_level_0 Queue Position` string, `MWs MW-1` int")
    raw.write.parquet(f"{tmp_path}/queue-report-06022025.parquet")
    landed = sheets.read_landed(spark, f"{tmp_path}/*.parquet")
    assert all(t == "string" for c, t in landed.dtypes)
    assert shape.shape_snapshot(landed, DAY).select("mw_1").first()[0] == 5.0


CLUSTER_HEADER = ["Queue Number", "Project Name", "NET MW POI", "Generation/Fuel 1", "PROJECT COUNTY", "Project State"]


def test_cluster_sheets(spark, tmp_path):
    write_plain_sheet(tmp_path / "a.csv", CLUSTER_HEADER, [
        ["2207", "Solar C15-001", "500.0", "Photovoltaic/Solar", "Kern", "CA"],
        ["", "Nobody", "1", "Wind", "Kern", "CA"],
    ])
    write_plain_sheet(tmp_path / "w.csv", [*CLUSTER_HEADER, "Withdrawal Date", "Remark"], [
        ["2208", "Gone", "x", "", "", "CA", "2025-03-01", "why"],
    ])
    write_plain_sheet(tmp_path / "n.csv", ["Notes"], [["skip me"]])
    raw = sheets.read_cluster(spark, {
        "Cluster 15 ": f"{tmp_path}/a.csv", "Withdrawn": f"{tmp_path}/w.csv", "Notes": f"{tmp_path}/n.csv",
    })
    got = shape.shape_cluster(raw, DAY)
    assert rows(
        got.select(
            "queue_position", "net_mw", "fuel_types", "study_process", "application_status", "withdrawal_date",
            "Remark", "latitude", "ingestion_date",
        ).orderBy("queue_position")
    ) == [
        ("2207", 500.0, "Photovoltaic/Solar", "C15", "Active", None, None, 35.3425, DAY),
        ("2208", None, "", "C15", "Withdrawn", at("2025-03-01"), "why", None, DAY),
    ]
    with pytest.raises(ValueError):
        shape.shape_cluster({"Notes": raw["Notes"]}, DAY)


def test_cast_keeps_unknown_columns_and_trims_processes(spark):
    df = spark.createDataFrame([(" C14 ", "1e3", "keep")], "study_process string, net_mw string, other string")
    assert rows(shape.cast_known_columns(df)) == [("C14", 1000.0, "keep")]


def test_snapshot_date_is_never_today(spark):
    raw = spark.createDataFrame([("Z1",)], "`Unnamed: 1_level_0 Queue Position` string")
    shaped = shape.shape_snapshot(raw, F.to_date(F.lit("2020-02-03")))
    assert shaped.first().ingestion_date == date(2020, 2, 3)


def test_every_file_under_its_own_header(spark, tmp_path):
    """140 columns, two layouts, a title with two cells, rows of other lengths, a clash with a header."""
    def write(name, header, records):
        with open(tmp_path / name, "w", newline="") as f:
            csv.writer(f).writerows([["Title one", "as of 2025"], ["Title two"], ["G"] * len(header), header, *records])

    write("queue-report-01062025.csv", ["Queue Position", "MW-1", *[f"Extra {k}" for k in range(138)]], [["1", "10", *map(str, range(138))], ["2"], [""]])
    write("queue-report-01132025.csv", ["Queue Position", "Project County", "MW-1", "State"], [["3", "Kern", "30", "CA", "beyond"], ["Queue Position", "", "", ""], ["Title one", "as of 2025"]])
    raw = sheets.read_snapshot(spark, f"{tmp_path}/*.csv")
    key, wide = raw.columns[0], raw.columns[139]
    assert len(raw.columns) == 140 + 2 + 1
    got = {r[key]: r.asDict() for r in raw.collect()}
    assert set(got) == {"1", "2", "3", "Queue Position", "Title one"}
    assert got["1"][wide] == "137" and got["2"][wide] is None and got["1"]["_file_name"] == "queue-report-01062025.csv"
    mw = next(c for c in raw.columns if "MW-1" in c)
    assert (got["1"][mw], got["3"][mw]) == ("10", "30")
    placed = shape.shape_snapshot(raw, sheets.file_date())
    assert [r.latitude for r in placed.where(f"`{key}` = '3'").collect()] == [35.3425]
    assert not {"county", "state"} & set(placed.columns)
