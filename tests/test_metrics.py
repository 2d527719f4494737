from datetime import date

import pytest
from helpers import DAY, at, rows

from backlog.operators import metrics, timing
from backlog.operators.scope import INTERACTIVE, REPORT
from backlog.sources.tables import ProjectTables

OLD = date(2024, 12, 30)


def project(**columns):
    return {"queue_position": "Z1", **columns}


def test_capacity_by_fuel(make_tables):
    t = make_tables(Active=[
        project(fuel_types="Solar", mw_1=100.0, net_mw=1.0),
        project(fuel_types="Solar", mw_1=150.0, net_mw=2.0),
        project(fuel_types="Wind", mw_1=200.0, net_mw=4.0),
        project(fuel_types="Solar/Wind", mw_1=None, net_mw=8.0),
        project(fuel_types="Solar", mw_1=999.0, net_mw=16.0, ingestion_date=OLD),
    ])
    assert sorted(rows(metrics.capacity_by_fuel(t, REPORT))) == [("Solar", 250.0), ("Solar/Wind", None), ("Wind", 200.0)]
    assert sorted(rows(metrics.capacity_by_fuel(t, INTERACTIVE))) == [("Solar", 19.0), ("Solar/Wind", 8.0), ("Wind", 4.0)]


def test_status_counts_always_has_three_rows(make_tables):
    t = make_tables(Active=[project(mw_1=100.0), project(mw_1=200.0)], Withdrawn=[project(mw_1=75.0)])
    assert rows(metrics.status_counts(t, REPORT)) == [("Active", 2, 300.0), ("Completed", 0, None), ("Withdrawn", 1, 75.0)]
    assert rows(metrics.status_counts(t, INTERACTIVE, ["C15"])) == [
        ("Active", 0, 0.0), ("Completed", 0, 0.0), ("Withdrawn", 0, 0.0),
    ]


def test_each_table_has_its_own_latest_snapshot(make_tables):
    t = make_tables(
        Active=[project(mw_1=1.0), project(mw_1=2.0, ingestion_date=OLD)],
        Completed=[project(mw_1=4.0, ingestion_date=OLD)],
        Withdrawn=[project(mw_1=8.0, ingestion_date=None)],
    )
    assert rows(metrics.status_counts(t, REPORT)) == [("Active", 1, 1.0), ("Completed", 1, 4.0), ("Withdrawn", 0, None)]


def test_top_zones(make_tables):
    zones = {"ISO-1": 300.0, "ISO-2": 400.0, "ISO-3": 300.0, "ISO-4": 50.0, "ISO-5": None, "ISO-6": 1.0}
    t = make_tables(Active=[project(pto_study_region=z, mw_1=mw) for z, mw in zones.items()])
    assert rows(metrics.top_zones(t, REPORT)) == [
        ("ISO-2", 400.0), ("ISO-1", 300.0), ("ISO-3", 300.0), ("ISO-4", 50.0), ("ISO-6", 1.0),
    ]


def test_cancellation_rate(make_tables):
    published = make_tables(
        Active=[project(mw_1=73038.12416164306)],
        Completed=[project(mw_1=34113.88999352694)],
        Withdrawn=[project(mw_1=370573.2313943588)],
    )
    assert metrics.cancellation_rate(published, REPORT).first()[0] == pytest.approx(0.7757036808219906, rel=1e-15)
    nothing = make_tables(Active=[project(mw_1=0.0)])
    assert rows(metrics.cancellation_rate(nothing, REPORT)) == [(None,)]
    assert rows(metrics.cancellation_rate(nothing, INTERACTIVE)) == [(0.0,)]


def test_lead_time(make_tables):
    t = make_tables(Active=[
        project(request_receive_date=at("2024-03-01 08:00"), queue_date=at("2024-03-11 07:00"), study_process="C14"),
        project(request_receive_date=at("2024-03-01 08:00"), queue_date=at("2024-03-02 08:00"), study_process="TC"),
        project(request_receive_date=None, queue_date=at("2024-03-02 08:00")),
    ])
    assert rows(timing.lead_time(t, REPORT)) == [(5.0,)]
    assert rows(timing.lead_time(t, INTERACTIVE, ["C14"])) == [(9.0,)]
    assert rows(timing.lead_time(t, INTERACTIVE, ["C99"])) == [(0.0,)]
    assert rows(timing.lead_time(make_tables(), REPORT)) == [(None,)]


def test_lead_time_bands(make_tables):
    start = at("2024-01-01")
    ends = ["2023-12-31", "2024-01-01", "2024-02-29", "2024-03-01", "2024-04-30", "2025-01-01"]
    t = make_tables(Active=[project(request_receive_date=start, queue_date=at(e)) for e in ends])
    got = dict(rows(timing.lead_time_bands(t, INTERACTIVE)))
    assert got == {"below 0": 1, "0-60": 2, "60-120": 1, "120+": 2}


def test_top_projects(make_tables):
    t = make_tables(Active=[
        project(project_name="B", queue_position="2", net_mw=500.0, fuel_types="Solar", county="X"),
        project(project_name="B", queue_position="2", net_mw=700.0, fuel_types="Wind", county="Y"),
        project(project_name="A", queue_position="1", net_mw=700.0, fuel_types="Gas", county="Z"),
        project(project_name="C", queue_position="3", net_mw=None),
        *[project(project_name=f"P{i:02d}", queue_position=str(i), net_mw=float(i)) for i in range(20)],
    ])
    got = metrics.top_projects(t, REPORT)
    assert got.columns == ["project_name", "queue_position", "net_mw", "fuel_types", "county", "state", "status"]
    listed = rows(got)
    assert len(listed) == 10
    assert listed[0][:5] == ("A", "1", 700.0, "Gas", "Z")
    assert listed[1][:5] == ("B", "2", 700.0, "Wind", "Y")
    assert listed[2][0] == "P19"
    assert "study_process" in metrics.top_projects(t, INTERACTIVE).columns


def delays(make_tables):
    planned = at("2025-01-10 08:00")
    ends = [("Solar", "2025-01-20 07:00"), ("Solar", "2025-01-09 08:00"), ("Wind", "2025-01-10 08:00"),
            ("Wind", "2025-01-15 20:00"), (None, "2025-01-12 08:00")]
    return make_tables(Active=[
        project(fuel_types=f, proposed_online_date=planned, current_online_date=at(e)) for f, e in ends
    ] + [project(fuel_types="Solar", proposed_online_date=planned)])


def test_delays(make_tables):
    t = delays(make_tables)
    assert sorted(r.delay_days for r in timing.delay_detail(t, REPORT).collect()) == [-1, 0, 2, 5, 9]
    summary = timing.delay_summary(t, REPORT).first()
    assert tuple(summary) == (3.0, 2.0, -1, 9, 3, 1, 1, 60.0)
    assert sorted(rows(timing.delay_by_fuel(t, REPORT))) == [("Solar", 4.0), ("Wind", 2.5)]


def test_late_projects_only(make_tables):
    t = delays(make_tables)
    got = rows(timing.late_by_fuel(t))
    assert got == [("Solar", pytest.approx(9 + 23 / 24)), ("Wind", 5.5), (None, 2.0)]


def test_delay_summary_of_nothing(make_tables):
    assert tuple(timing.delay_summary(make_tables(), REPORT).first()) == (None, None, None, None, 0, 0, 0, 0.0)


def test_overview(make_tables):
    t = make_tables(
        Active=[project(net_mw=10.0, request_receive_date=at("2024-01-01"), queue_date=at("2024-01-04"))],
        Completed=[project(net_mw=5.0), project(net_mw=None)],
        Withdrawn=[project(net_mw=5.0, request_receive_date=at("2024-01-01"), queue_date=at("2025-01-01"))],
    )
    assert rows(metrics.overview(t, INTERACTIVE)) == [(1, 10.0, 2, 5.0, 4, 20.0, 0.25, 3.0)]
    assert rows(metrics.overview(make_tables(), INTERACTIVE)) == [(0, 0.0, 0, 0.0, 0, 0.0, 0.0, 0.0)]


def test_study_processes(make_tables):
    t = make_tables(
        Active=[project(study_process=p) for p in ("C01", "C14", "TC", " TC ", " ", None)],
        Completed=[project(study_process="C02")],
        Withdrawn=[project(study_process="C03")],
    )
    assert [r[0] for r in rows(metrics.study_processes(t))] == ["C01", "C02", "C03", "C14", "C15", "TC"]
    early = make_tables(Active=[project(study_process="C13"), project(study_process="TC")])
    assert [r[0] for r in rows(metrics.study_processes(early))] == ["C13", "TC"]
    there = make_tables(Active=[project(study_process="C15"), project(study_process="C16")])
    assert [r[0] for r in rows(metrics.study_processes(there))] == ["C15", "C16"]


def test_study_summary(make_tables):
    t = make_tables(
        Active=[project(study_process="C14", net_mw=1.0), project(study_process="TC", net_mw=None)],
        Withdrawn=[project(study_process="C14", net_mw=2.0), project(study_process=None, net_mw=9.0)],
    )
    assert rows(metrics.study_summary(t)) == [("C14", 2, 3.0), ("TC", 1, None)]
    assert rows(metrics.study_summary(t, ["TC"])) == [("TC", 1, None)]


def test_cluster(make_tables):
    cluster = [
        {"queue_position": f"C15-00{i}", "fuel_types": fuel, "net_mw": mw, "ingestion_date": DAY}
        for i, (fuel, mw) in enumerate([("Solar", 100.0), ("Wind", 200.0), ("Storage", 50.0)])
    ]
    t = make_tables(cluster=cluster)
    assert rows(metrics.cluster_summary(t)) == [(3, 350.0)]
    assert rows(metrics.cluster_capacity_by_fuel(t)) == [("Wind", 200.0), ("Solar", 100.0), ("Storage", 50.0)]
    assert rows(metrics.latest_ingestion(t)) == [(DAY,)]


def test_missing_tables_read_as_empty(spark):
    t = ProjectTables(spark)
    assert t.cluster().count() == 0
    assert rows(metrics.cluster_summary(t)) == [(0, 0.0)]
    assert rows(metrics.cluster_capacity_by_fuel(t)) == []
    assert rows(metrics.top_zones(t, INTERACTIVE)) == []
    assert rows(metrics.study_processes(t)) == []
    assert rows(metrics.latest_ingestion(t)) == [(None,)]
    assert rows(metrics.latest_ingestion_label(t)) == [("Unavailable",)]


def test_latest_ingestion_label(make_tables):
    t = make_tables(Active=[project(ingestion_date=date(2025, 6, 2))], Completed=[project(ingestion_date=OLD)])
    assert rows(metrics.latest_ingestion_label(t)) == [("June 02, 2025",)]


def test_weekly_growth(make_tables):
    t = make_tables(Active=[
        project(mw_1=10.0, ingestion_date=OLD), project(mw_1=5.0, ingestion_date=OLD), project(mw_1=7.0),
    ])
    got = sorted(rows(metrics.weekly_growth(t)))
    assert got == [("Active", OLD, 15.0, None), ("Active", DAY, 7.0, -8.0)]


def test_results_do_not_depend_on_partitioning(spark, make_tables):
    t = delays(make_tables)
    spread = ProjectTables(spark, {n: t.scan(n).repartition(7) for n in t.names()})
    assert rows(timing.delay_summary(spread, REPORT)) == rows(timing.delay_summary(t, REPORT))
    assert rows(timing.late_by_fuel(spread)) == rows(timing.late_by_fuel(t))
