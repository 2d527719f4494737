from datetime import date

import pytest
from helpers import at, plan, rows
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.operators import browse, metrics
from backlog.operators.scope import INTERACTIVE, REPORT
from backlog.plans import reports
from backlog.sources.reports import write_csv
from backlog.sources.store import StoredTable, StoredTables, VersionTaken, incoming_rows
from backlog.streaming.ingest import ingest_new_files

D1, D2, D3 = date(2025, 1, 6), date(2025, 1, 13), date(2025, 1, 20)
HEADERS = [
    "Unnamed: 0_level_0 Project Name", "Unnamed: 1_level_0 Queue Position", "Generating Facility Fuel-1", "MWs MW-1",
    "MWs Net MWs to Grid", "Location County", "Location State",
]


def raw(spark, *records):
    names = ", ".join(f"`{h}` string" for h in HEADERS)
    return spark.createDataFrame([tuple(r) for r in records], names)


def project(key, mw, name="P", county="Kern"):
    return (name, key, "Solar", str(mw), str(mw), county, "CA")


def held(table):
    return sorted(rows(table.read().select("queue_position", S.SNAPSHOT, "mw_1")))


def test_loads_are_idempotent_and_versioned(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)
    assert not table.exists() and table.read().count() == 0

    def load(day, *keys):
        batch = make([{"queue_position": k, "mw_1": 1.0, S.SNAPSHOT: day} for k in keys], *S.PROJECT_COLUMNS)
        return table.load(batch, day)

    assert load(D1, "A", "B") == 1
    assert load(D2, "A", "C") == 2
    after = [("A", D2, 1.0), ("B", D1, 1.0), ("C", D2, 1.0)]
    assert held(table) == after
    assert load(D2, "A", "C") == 3
    assert held(table) == after
    load(D3, "A", "B", "C")
    assert held(table) == [(k, D3, 1.0) for k in "ABC"]  # the older partitions are gone
    load(D1, "A", "Z")  # a late file
    assert held(table) == [("A", D1, 1.0), ("A", D3, 1.0), ("B", D3, 1.0), ("C", D3, 1.0), ("Z", D1, 1.0)]
    assert rows(table.duplicate_keys()) == [("A", 2)]


def test_retention_and_old_versions(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)
    assert table.drop_old_versions() == []
    for key, day in (("A", date(2023, 1, 2)), ("B", D1), ("C", D2)):
        table.load(make([{"queue_position": key, "mw_1": 1.0, S.SNAPSHOT: day}], *S.PROJECT_COLUMNS), day)
    assert table.retain(D2) == 4
    assert held(table) == [("B", D1, 1.0), ("C", D2, 1.0)]
    assert table.drop_old_versions() == [1, 2]
    assert table.drop_old_versions(keep=0) == [3]
    assert held(table) == [("B", D1, 1.0), ("C", D2, 1.0)]


def test_an_uncommitted_version_is_not_read(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "completed_projects", S.PROJECT_SCHEMA)
    batch = make([{"queue_position": "A", "mw_1": 1.0, S.SNAPSHOT: D1}], *S.PROJECT_COLUMNS)
    table.replace(batch)
    batch.withColumn("queue_position", F.lit("LOST")).write.partitionBy(S.SNAPSHOT).parquet(table._data(2))
    assert held(table) == [("A", D1, 1.0)]
    assert table.replace(batch.withColumn("queue_position", F.lit("B"))) == 2
    assert held(table) == [("B", D1, 1.0)]


def test_outdated_layout_is_rebuilt(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "withdrawn_projects", S.PROJECT_SCHEMA)
    raw_name = "Unnamed: 0_level_0 Project Name - Confidential"
    old = make([{"queue_position": "OLD", "county": "KERN", "state": "CA", S.SNAPSHOT: D1}])
    table.replace(old.withColumn(raw_name, F.lit("Old farm")))
    table.load(make([{"queue_position": "NEW", S.SNAPSHOT: D2}], *S.PROJECT_COLUMNS), D2)
    got = sorted(rows(table.read().select("queue_position", "project_name", "latitude", S.SNAPSHOT)))
    assert got == [("NEW", None, None, D2), ("OLD", "Old farm", 35.3425, D1)]
    assert raw_name not in table.read().columns


def test_a_load_leaves_other_days_alone(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)

    def load(day, *keys):
        table.load(make([{"queue_position": k, "mw_1": 1.0, S.SNAPSHOT: day} for k in keys], *S.PROJECT_COLUMNS), day)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}

    load(D1, "A", "B")
    load(D2, "C", "D")
    before, (days, _) = files(), table._manifest(2)
    load(D3, "C", "E")  # takes C from the second day
    after = files()
    assert before.items() <= after.items()
    assert {f.split("ingestion_date=")[1][:10] for f in after.keys() - before.keys()} == {str(D2), str(D3)}
    assert table._manifest(3)[0][f"ingestion_date={D1}"] == days[f"ingestion_date={D1}"]
    assert held(table) == [("A", D1, 1.0), ("B", D1, 1.0), ("C", D3, 1.0), ("D", D2, 1.0), ("E", D3, 1.0)]
    assert table.newest_date() == D3
    table.retain(D3 + (D2 - D1), weeks=2)
    assert files() == after and held(table) == [("C", D3, 1.0), ("D", D2, 1.0), ("E", D3, 1.0)]


def test_the_second_of_two_loads_fails(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)
    batch = make([{"queue_position": "A", "mw_1": 1.0, S.SNAPSHOT: D1}], *S.PROJECT_COLUMNS)
    base = table.version()
    table.load(batch, D1)
    with pytest.raises(VersionTaken):
        table._commit(base, {}, S.PROJECT_SCHEMA)
    assert held(table) == [("A", D1, 1.0)]


def test_loads_of_different_days_do_not_fail(spark, tmp_path, make):
    """A load that another one of a different day has overtaken starts anew on top of it."""
    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)

    def batch(day, *keys):
        return make([{"queue_position": k, "mw_1": 1.0, S.SNAPSHOT: day} for k in keys], *S.PROJECT_COLUMNS)

    table.load(batch(D1, "A", "B"), D1)

    class Overtaken(StoredTable):
        others: list = []

        def _write(self, *args):
            written = super()._write(*args)
            if self.others:
                day, keys = self.others.pop()
                table.load(batch(day, *keys), day)
            return written

    slow = Overtaken(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)
    slow.others = [(D2, "BC")]
    counts = slow.load_counted(batch(D3, "B", "D"), D3)  # the other load's B is superseded too
    assert (counts.version, counts.rows_written, counts.rows_superseded) == (3, 2, 1)
    assert held(table) == [("A", D1, 1.0), ("B", D3, 1.0), ("C", D2, 1.0), ("D", D3, 1.0)]
    slow.others = [(D3, "Z")]
    with pytest.raises(VersionTaken):
        slow.load(batch(D3, "Y"), D3)
    assert held(table) == [("A", D1, 1.0), ("C", D2, 1.0), ("Z", D3, 1.0)]


def test_a_commit_is_there_whole_or_not_at_all(spark, tmp_path, make):
    """A reader between the making of a record and its end, and a load that died there, change nothing."""
    table = StoredTable(spark, str(tmp_path), "completed_projects", S.PROJECT_SCHEMA)
    batch = make([{"queue_position": "A", "mw_1": 1.0, S.SNAPSHOT: D1}], *S.PROJECT_COLUMNS)
    seen = []

    class Watched(StoredTable):
        def _at(self, *parts):
            if parts[0] == "commits" and parts[-1].endswith(".json"):  # asked for once the record is begun
                seen.append(table.version() and len(held(table)))
            return super()._at(*parts)

    table.load(batch, D1)
    commits = tmp_path / "completed_projects" / "commits"
    (commits / ".dead.tmp").write_text("")
    Watched(spark, str(tmp_path), "completed_projects", S.PROJECT_SCHEMA).load(batch.withColumn("queue_position", F.lit("B")), D2)
    assert set(seen) == {1} and table.version() == 2
    assert sorted(f.name for f in commits.iterdir() if not f.name.endswith(".crc")) == [".dead.tmp", "1.json", "2.json"]
    with pytest.raises(VersionTaken):
        table._commit(1, {}, S.PROJECT_SCHEMA)
    assert len([f for f in commits.iterdir() if f.name.endswith(".tmp")]) == 1


def test_counts_of_the_load(spark, tmp_path, make):
    """Read, dropped, written, replaced and superseded rows, by the job that writes; of one snapshot and of several."""
    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)

    def batch(*rows):
        return make([{"queue_position": k, "mw_1": 1.0, S.SNAPSHOT: day} for k, day in rows], *S.PROJECT_COLUMNS)

    def counts(c):
        return c.rows_read, c.rows_dropped, c.rows_outdated, c.rows_written, c.rows_replaced, c.rows_superseded

    assert counts(table.load_counted(batch(("A", D1), ("B", D1), (" ", D1), (None, D1)), D1)) == (4, 2, 0, 2, 0, 0)
    assert counts(table.load_counted(batch(("A", D2), ("C", D2), ("C", D2)), D2)) == (3, 0, 0, 3, 0, 1)
    assert counts(table.load_counted(batch(("C", D2)), D2)) == (1, 0, 0, 1, 3, 0)
    assert counts(table.load_counted(batch(("B", D2), ("B", D3), ("D", None), (" ", D3), ("E", D2)))) == (5, 2, 1, 2, 1, 1)
    assert held(table) == [("B", D3, 1.0), ("E", D2, 1.0)]
    assert counts(table.load_counted(batch().limit(0), D2)) == (0, 0, 0, 0, 1, 0)
    assert counts(table.load_counted(batch(("A", D1)).limit(0))) == (0, 0, 0, 0, 0, 0)
    assert held(table) == [("B", D3, 1.0)]
    assert not list((tmp_path / "grid_generation_queue").glob("incoming/*"))


def test_a_batch_is_worked_out_once(spark, tmp_path, make):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)
    batch = make([{"queue_position": str(k), S.SNAPSHOT: D1} for k in range(10)], *S.PROJECT_COLUMNS)
    table.load(batch, D1)
    table.load(batch.mapInArrow(counted, batch.schema), D2)
    assert seen.value == 10


def test_a_raw_header_is_renamed_without_writing_its_days_anew(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "withdrawn_projects", S.PROJECT_SCHEMA)
    names, mw = "Unnamed: 0_level_0 Project Name - Confidential", "MWs MW-1"
    old = make([{"queue_position": k, "latitude": None, "longitude": None, S.SNAPSHOT: D1} for k in ("OLD", "BOTH")])
    table.replace(old.withColumns({names: F.lit("Old farm"), mw: F.lit("12.5")}))
    files = set(tmp_path.rglob("*.parquet"))
    table.load(make([{"queue_position": "NEW", "project_name": "New", "mw_1": 3.0, S.SNAPSHOT: D2}], *S.PROJECT_COLUMNS), D2)
    assert files < set(tmp_path.rglob("*.parquet")) and table._manifest(2)[0][f"{S.SNAPSHOT}={D1}"] == table._manifest(1)[0][f"{S.SNAPSHOT}={D1}"]
    want = [("BOTH", "Old farm", 12.5, D1), ("NEW", "New", 3.0, D2), ("OLD", "Old farm", 12.5, D1)]
    assert sorted(rows(table.read().select("queue_position", "project_name", "mw_1", S.SNAPSHOT))) == want
    assert not {names, mw} & set(table.read().columns)
    table.load(make([{"queue_position": "BOTH", "project_name": "Newer", "mw_1": 4.0, S.SNAPSHOT: D3}], *S.PROJECT_COLUMNS), D3)
    assert sorted(rows(table.read().select("queue_position", "project_name", "mw_1", S.SNAPSHOT))) == [("BOTH", "Newer", 4.0, D3), *want[1:]]


def test_unknown_columns_are_kept(spark, tmp_path, make):
    table = StoredTable(spark, str(tmp_path), "grid_generation_queue", S.PROJECT_SCHEMA)
    plain = make([{"queue_position": "A", S.SNAPSHOT: D1}])
    table.load(incoming_rows(plain), D1)
    table.load(incoming_rows(make([{"queue_position": "B", S.SNAPSHOT: D2}]).withColumn("extra", F.lit("x"))), D2)
    got = sorted(rows(table.read().select("queue_position", "extra")))
    assert got == [("A", None), ("B", "x")]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    sheets = {
        S.ACTIVE: raw(spark, project("1", 100), project("2", 200, county="KERN/RIVERSIDE"), project(" ", 1)),
        S.COMPLETED: raw(spark, project("3", 150)),
        S.WITHDRAWN: raw(spark, project("4", 50, county=None)),
    }
    outcomes = reports.load_snapshot(StoredTables(spark, root), sheets, D1)
    assert [o.error for o in outcomes] == [None] * 3
    cluster = spark.createDataFrame(
        [("2207", "500.0", "Photovoltaic/Solar", "Kern", "CA")],
        "`Queue Number` string, `NET MW POI` string, `Generation/Fuel 1` string, `PROJECT COUNTY` string, `Project State` string",
    )
    for _ in range(2):
        assert reports.load_cluster(StoredTables(spark, root), {"Cluster 15 ": cluster}, D1).ok
    return StoredTables(spark, root)


def test_loaded_tables_answer_queries(store):
    assert rows(metrics.status_counts(store, REPORT)) == [("Active", 2, 300.0), ("Completed", 1, 150.0), ("Withdrawn", 1, 50.0)]
    assert rows(metrics.cancellation_rate(store, INTERACTIVE)) == [(0.1,)]
    assert rows(metrics.cluster_summary(store)) == [(1, 500.0)]
    assert browse.project_locations(store).count() == 3
    assert rows(metrics.latest_ingestion(store)) == [(D1,)]


def test_reports_are_written_and_failures_isolated(spark, store, tmp_path, make_tables):
    outcomes = reports.write_reports(store, str(tmp_path))
    assert [o.ok for o in outcomes] == [True] * 7
    got = spark.read.csv(f"{tmp_path}/project_count_by_status", header=True)
    assert rows(got) == [("Active", "2", "300.0"), ("Completed", "1", "150.0"), ("Withdrawn", "1", "50.0")]

    class Broken(type(store)):
        def table(self, status, columns=None):
            if columns and "pto_study_region" in columns:
                raise RuntimeError("no regions")
            return super().table(status, columns)

    broken = Broken.__new__(Broken)
    broken.__dict__.update(store.__dict__)
    outcomes = {o.name: o for o in reports.write_reports(broken, f"{tmp_path}/again")}
    assert outcomes["top5_iso_zones"].error == "no regions"
    assert sum(o.ok for o in outcomes.values()) == 6


def test_browse_result_as_csv(spark, store, tmp_path):
    chosen = browse.filter_projects(
        browse.projects(store, "all", ["project_name", "queue_position", "net_mw"]), min_capacity=100
    )
    write_csv(chosen, f"{tmp_path}/export")
    back = spark.read.csv(f"{tmp_path}/export", header=True)
    assert back.columns == ["project_name", "queue_position", "net_mw", "status"]
    assert sorted(r.queue_position for r in back.collect()) == ["1", "2", "3"]


def test_a_report_is_published_in_one_step(spark, tmp_path, make):
    """The former report stays until the new one is whole, also when writing that fails."""
    path = str(tmp_path / "report")

    def listed():
        return sorted(rows(spark.read.csv(path, header=True, escape='"')))

    def broken(batches):
        yield from batches
        raise RuntimeError("lost")

    first = spark.createDataFrame([("a", 1), (" b ", 2), ('say "x"', 3)], "name string, n int")
    write_csv(first, path)
    before = listed()
    assert before == [(" b ", "2"), ("a", "1"), ('say "x"', "3")]
    with pytest.raises(Exception, match="lost"):
        write_csv(first.mapInArrow(broken, first.schema), path)
    assert listed() == before
    write_csv(first.where("n = 1"), path)
    assert listed() == [("a", "1")]
    write_csv(first.where("n = 1"), path)
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith("_report")] == ["report"] and listed() == [("a", "1")]


def test_all_nine_reports(spark, make_tables, tmp_path):
    t = make_tables(
        Active=[
            {"queue_position": str(i), "project_name": f"P{i}", "mw_1": float(i), "net_mw": float(i),
             "fuel_types": f"Fuel {7 * i % 20:02d}", "pto_study_region": f"Zone {3 * i % 10}",
             "proposed_online_date": at("2025-01-01"), "current_online_date": at("2025-02-01")}
            for i in range(40)
        ],
    )
    assert all(o.ok for o in reports.write_reports(t, str(tmp_path)))
    assert sorted(p.name for p in tmp_path.iterdir()) == [
        "average_lead_time", "cancellation_rate", "capacity_by_fuel", "project_count_by_status",
        "project_timeline_delays", "timeline_delay_by_fuel", "timeline_delay_summary", "top5_iso_zones",
        "top_projects_by_net_mw",
    ]

    def listed(name):
        return rows(spark.read.csv(f"{tmp_path}/{name}", header=True))

    fuels = listed("capacity_by_fuel")
    assert fuels == sorted(fuels) and len(fuels) == 20
    zones = [float(r[1]) for r in listed("top5_iso_zones")]
    assert zones == sorted(zones, reverse=True) and len(zones) == 5
    assert [r[0] for r in listed("top_projects_by_net_mw")] == [f"P{i}" for i in range(39, 29, -1)]


def test_stream_loads_each_file_once(spark, tmp_path):
    landing, checkpoint = f"{tmp_path}/landing", f"{tmp_path}/checkpoint"
    table = StoredTable(spark, f"{tmp_path}/store", "grid_generation_queue", S.PROJECT_SCHEMA)

    def land(day, *records):
        part = f"{tmp_path}/part-{day}"
        raw(spark, *records).coalesce(1).write.parquet(part)
        source = next((tmp_path / f"part-{day}").glob("*.parquet"))
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / f"queue-report-{day:%m%d%Y}.parquet").write_bytes(source.read_bytes())

    def run():
        query = ingest_new_files(spark, landing, HEADERS, table, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None

    land(D1, project("A", 1), project("B", 2), project("", 3))
    land(D2, project("A", 4))
    run()
    assert held(table) == [("A", D2, 4.0), ("B", D1, 2.0)]
    version = table.version()
    run()  # nothing new
    assert table.version() == version
    land(date(2024, 12, 30), project("A", 9), project("C", 9))  # late
    run()
    assert held(table) == [("A", date(2024, 12, 30), 9.0), ("A", D2, 4.0), ("B", D1, 2.0), ("C", date(2024, 12, 30), 9.0)]


def test_stream_keeps_unknown_columns(spark, tmp_path):
    landing = tmp_path / "landing"
    landed = raw(spark, project("1", 100)).withColumn("Remark", F.lit("new")).withColumn("Number", F.lit(7))
    landed.coalesce(1).write.parquet(f"{tmp_path}/part")
    landing.mkdir()
    (landing / "queue-report-01062025.parquet").write_bytes(next((tmp_path / "part").glob("*.parquet")).read_bytes())
    table = StoredTable(spark, f"{tmp_path}/store", "grid_generation_queue", S.PROJECT_SCHEMA)
    ingest_new_files(spark, str(landing), HEADERS, table, f"{tmp_path}/progress").awaitTermination()
    assert rows(table.read().select("queue_position", "Remark", "Number")) == [("1", "new", "7")]


def test_stream_of_late_repeated_and_wider_files(spark, tmp_path):
    """One file a batch: each under its own columns, in whatever order they land, also while the stream runs."""
    landing = tmp_path / "landing"
    landing.mkdir()
    table = StoredTable(spark, f"{tmp_path}/store", "grid_generation_queue", S.PROJECT_SCHEMA)

    def land(day, df):
        part = tmp_path / f"part-{len(list(tmp_path.iterdir()))}"
        df.coalesce(1).write.parquet(str(part))
        (landing / f"queue-report-{day:%m%d%Y}.parquet").write_bytes(next(part.glob("*.parquet")).read_bytes())

    def run():
        query = ingest_new_files(spark, str(landing), HEADERS, table, f"{tmp_path}/progress", files=1)
        query.awaitTermination(180)
        assert query.exception() is None
        return len([p for p in query.recentProgress if p["numInputRows"]])

    land(D2, raw(spark, project("A", 4), project("B", 2)))
    land(D1, raw(spark, project("A", 1), project("C", 3)).withColumn("Remark", F.lit("late and wide")))
    land(D3, raw(spark, project("B", 5)).drop("Location State").withColumn("Number", F.lit(7)))
    assert run() == 3
    want = {("A", D2, 4.0), ("C", D1, 3.0), ("B", D3, 5.0)}
    got = set(held(table))
    assert got - {("A", D1, 1.0)} == want  # a late row of a newer key stays, as if loaded in that order
    assert {"Remark", "Number"} <= set(table.read().columns)
    assert rows(table.read().where("queue_position = 'C'").select("Remark")) == [("late and wide",)]
    land(D2, raw(spark, project("A", 4), project("B", 2)))  # the same name again: done already
    land(date(2025, 1, 27), raw(spark, project("C", 6)).withColumn("Later", F.lit("x")))
    run()
    assert ("C", date(2025, 1, 27), 6.0) in held(table) and "Later" in table.read().columns


def test_the_newest_date_comes_from_the_commit_record(store):
    for question in (metrics.capacity_by_fuel(store, REPORT), metrics.status_counts(store, REPORT)):
        text = plan(question)
        assert "Subquery" not in text and text.count(f"(ingestion_date") >= 1 and str(D1) in text
    assert store.newest_date(S.ACTIVE) == D1
