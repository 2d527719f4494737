"""Sums kept per day, search by trigrams, cells of a map, tables dealt by key or by ranges."""

import random
import re
from datetime import date

import pytest
from helpers import at, plan, rows
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.operators import browse, cells, metrics, snapshots, sums, timing
from backlog.operators.scope import INTERACTIVE, REPORT
from backlog.operators.search import TextIndex, required, trigrams
from backlog.sources.bucketed import BucketedTable
from backlog.sources.ranged import RangedTable

D1, D2, D3 = date(2025, 1, 6), date(2025, 1, 13), date(2025, 1, 20)


def projects(rng, n, days=(D1, D2, D3)):
    return [
        {
            "queue_position": str(rng.randrange(n)), S.SNAPSHOT: rng.choice(days), "study_process": rng.choice(["C14", "TC", None]),
            "fuel_types": rng.choice(["Solar", "Wind/Solar", None]), "pto_study_region": rng.choice(["N", "S", None]),
            "mw_1": rng.choice([None, 1.0, 2.5]), "net_mw": rng.choice([None, 4.0, 8.25]),
            "request_receive_date": rng.choice([None, at("2024-01-01")]), "queue_date": rng.choice([None, at("2024-03-01")]),
        }
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def tables(make_tables):
    rng = random.Random(4)
    return make_tables(Active=projects(rng, 60), Completed=projects(rng, 40, (D1, D2)), Withdrawn=projects(rng, 30))


@pytest.fixture(scope="module")
def kept(tables):
    return sums.sums_of(tables.all_projects(list(sums.INPUTS)))


@pytest.mark.parametrize("family", [REPORT, INTERACTIVE])
@pytest.mark.parametrize("studies", [None, ["C14"], ["none"]])
def test_kpis_from_sums(tables, kept, family, studies):
    def same(ours, theirs):
        assert sorted(rows(ours), key=repr) == sorted(rows(theirs.select(*ours.columns)), key=repr)

    for name in ("capacity_by_fuel", "top_zones", "status_counts", "cancellation_rate", "overview"):
        same(getattr(sums, name)(kept, family, studies), getattr(metrics, name)(tables, family, studies))
    same(sums.lead_time(kept, family, studies), timing.lead_time(tables, family, studies))
    if family == INTERACTIVE:
        same(sums.study_summary(kept, studies), metrics.study_summary(tables, studies))
        same(sums.weekly_growth(kept), metrics.weekly_growth(tables))


def test_sums_after_a_load(tables, make):
    """Only the days that a load touches are summed up anew."""
    before = tables.table(S.ACTIVE, [*S.PROJECT_COLUMNS, "status"])
    new = make(projects(random.Random(9), 25, (D2,)), *S.PROJECT_COLUMNS).withColumn("status", F.lit(S.ACTIVE))
    keys = ("status", S.KEY)
    after = snapshots.upsert(before, new, D2, keys)
    gone = snapshots.superseded(before, new.withColumn(S.SNAPSHOT, F.lit(D2)), keys)
    days = gone.select("status", S.SNAPSHOT).unionByName(new.select("status", F.lit(D2).alias(S.SNAPSHOT)))
    touched = [r[1] for r in rows(days.distinct())]
    assert 1 < len(touched) < 3
    anew = sums.sums_of(after.where(F.col(S.SNAPSHOT).isin(touched)))
    got = sums.replaced(sums.sums_of(before), days, anew)
    assert sorted(rows(got), key=repr) == sorted(rows(sums.sums_of(after).select(*got.columns)), key=repr)


def test_sums_are_small(spark, tmp_path, tables, kept):
    """The stored sums have a row for each day and group, and a KPI of one day reads that day only."""
    kept.write.partitionBy(S.SNAPSHOT).parquet(str(tmp_path / "sums"))
    back = spark.read.parquet(str(tmp_path / "sums"))
    groups = tables.all_projects(list(sums.KEYS)).distinct().count()
    assert back.count() == groups
    text = plan(sums.capacity_by_fuel(back, REPORT))
    assert "PartitionFilters: [isnotnull(ingestion_date" in text


PATTERNS = ["solar", "SOLAR farm", "a|b", "wind.*4[0-9]", "far+m 1", "x?farm", "ab{0,2}", "(solar)", r"farm \d", r"far\x6d", "[sw]ol", "", "fa", "é", r"1\.5", "^Solar", "farm 1$"]


@pytest.fixture(scope="module")
def names(spark):
    rng = random.Random(6)
    parts = ["Solar", "Wind", "FARM", "farm", "Río", "1.5", "4", "41", "ééé", "fa", "x"]
    made = [" ".join(rng.choice(parts) for _ in range(rng.randrange(5))) for _ in range(300)] + [None, ""]
    return spark.createDataFrame([(n, k) for k, n in enumerate(made)], "project_name string, key int")


def test_search_by_trigrams(spark, tmp_path, names):
    index = TextIndex(spark, str(tmp_path), "project_name", parts=16).write(names)
    for pattern in PATTERNS:
        want = browse.filter_projects(names, search=pattern) if pattern else names.where("project_name is not null")
        assert sorted(rows(index.search(pattern)), key=repr) == sorted(rows(want.select("project_name", "key")), key=repr), pattern
    for words in (["Solar"], ["farm 4", "Wind W"], ["x"], ["Solar", "fa"]):
        want = browse.filter_projects(names.withColumnRenamed("project_name", "fuel_types"), fuels=words)
        assert sorted(rows(index.containing(words))) == sorted(rows(want))


def test_required_trigrams_are_in_every_match():
    rng = random.Random(8)
    items = ["a", "b", "c", "+", "?", "*", ".", "[ab]", "[^c]", "{2}", "{0,1}", r"\.", "-", r"\d"]
    for _ in range(3000):
        pattern = "".join(rng.choice(items) for _ in range(rng.randrange(1, 9)))
        try:
            compiled = re.compile(pattern, re.IGNORECASE)
        except re.error:
            continue
        needed = required(pattern)
        for _ in range(30):
            text = "".join(rng.choice("abc.-1") for _ in range(rng.randrange(12)))
            if compiled.search(text):
                assert needed <= trigrams(text), (pattern, text)


def test_search_reads_few_parts(spark, tmp_path):
    """A search for one name out of ten thousand reads the part it is in, not the table."""
    many = spark.range(10_000).select(F.concat(F.lit("Project "), F.md5(F.col("id").cast("string"))).alias("project_name"), "id")
    index = TextIndex(spark, str(tmp_path), "project_name", parts=64).write(many)
    name = many.where("id = 777").first().project_name
    found = index.search(re.escape(name).replace(r"\ ", " "))
    assert [r.id for r in found.collect()] == [777]
    read = {f.split("part=")[1].split("/")[0] for f in found.inputFiles()}
    assert len(read) == 64  # of the whole table; the plan prunes
    text = plan(found)
    assert re.search(r"PartitionFilters: \[.*part#\d+ = \d+", text)


def test_cells(spark):
    rng = random.Random(5)
    made = [("P", f"c{k % 9}", "S", 1.0 + k % 3, rng.uniform(-90, 90), rng.uniform(-180, 180), "Active") for k in range(60)]
    made += [("P", "edge", "S", 2.0, -90.0, 180.0, "Active"), (None, "none", "S", 5.0, 0.0, 0.0, "Active")]
    locations = spark.createDataFrame(made, "project_name string, county string, state string, capacity double, latitude double, longitude double, status string")
    places = browse.location_rollup(locations).where("project_count > 0").collect()
    out = cells.zoom_rollup(locations, 20).collect()
    for level in range(21):
        own = [r for r in out if r.level == level]
        assert sum(r.project_count for r in own) == 61 and sum(r.total_capacity for r in own) == sum(p.total_capacity for p in places)
        assert all(len(r.cell) == level for r in own) and sum(r.places for r in own) == len(places)
    finest = {(r.project_count, r.total_capacity, round(r.latitude, 9), round(r.longitude, 9)) for r in out if r.level == 20}
    assert finest == {(p.project_count, p.total_capacity, round(p.latitude, 9), round(p.longitude, 9)) for p in places}
    quarters = {(r.cell, r.project_count) for r in out if r.level == 1}
    by_hand = {}
    for p in places:
        key = str((p.longitude >= 0) + 2 * (p.latitude <= 0))
        by_hand[key] = by_hand.get(key, 0) + p.project_count
    assert quarters == set(by_hand.items())


@pytest.fixture(scope="module")
def ranged(spark, tmp_path_factory, make):
    """Ten days; one of them, and one number of MW, hold a third of all rows each."""
    rng = random.Random(2)
    days = [D1, *[date(2025, 2, d) for d in range(1, 10)]]
    made = [
        {"queue_position": str(k), S.SNAPSHOT: None if k % 50 == 0 else days[0] if k % 3 else rng.choice(days), "net_mw": None if k % 40 == 0 else 100.0 if k % 3 == 1 else rng.uniform(1, 500)}
        for k in range(3000)
    ]
    rows_ = make(made, "queue_position", S.SNAPSHOT, "net_mw")
    return rows_, RangedTable(spark, str(tmp_path_factory.mktemp("ranged"))).write(rows_, 30)


def test_questions_to_a_ranged_table(ranged):
    df, table = ranged
    assert sorted(rows(table.read().select(*df.columns)), key=repr) == sorted(rows(df), key=repr)
    newest = max(r[S.SNAPSHOT] for r in df.collect() if r[S.SNAPSHOT])
    assert sorted(rows(table.latest()), key=repr) == sorted(rows(df.where(F.col(S.SNAPSHOT) == F.lit(newest))), key=repr)
    for mw in (0.0, 100.0, 450.0, 1e9):
        assert sorted(rows(table.at_least(mw)), key=repr) == sorted(rows(df.where(F.col("net_mw") >= mw)), key=repr)
    for n in (1, 10, 2000, 5000):
        want = df.where("net_mw is not null").orderBy(F.desc("net_mw"), F.asc_nulls_first("queue_position"), F.asc_nulls_first(S.SNAPSHOT)).limit(n)
        assert rows(table.largest(n, "queue_position", S.SNAPSHOT).select("net_mw", "queue_position")) == rows(want.select("net_mw", "queue_position"))


def test_a_ranged_table_skips_files(ranged):
    df, table = ranged
    files = len(table.read().inputFiles())
    assert files >= 25
    assert len(table.latest().inputFiles()) <= 3 and len(table.at_least(499.0).inputFiles()) < files / 2
    sizes = [r.n for r in table._files().collect()]
    assert max(sizes) < 10 * 3000 / files  # neither the hot day nor the hot MW is one file


def test_an_empty_ranged_table(spark, tmp_path, ranged):
    df, _ = ranged
    table = RangedTable(spark, str(tmp_path)).write(df.limit(0), 4)
    assert table.latest().count() == table.at_least(1).count() == table.largest(3).count() == 0


@pytest.fixture
def dealt(spark, tmp_path, make):
    rng = random.Random(3)
    stored = make(projects(rng, 400), *S.PROJECT_COLUMNS).where("queue_position is not null")
    hot = make([{"queue_position": "1", S.SNAPSHOT: D1, "mw_1": float(k)} for k in range(300)], *S.PROJECT_COLUMNS)
    stored = stored.unionByName(hot)
    name = f"dealt_{tmp_path.name.replace('-', '_')}_{rng.randrange(10**9)}"
    yield stored, BucketedTable(spark, name, buckets=8).write(stored, str(tmp_path / "table"))
    spark.sql(f"DROP TABLE {name}")


def test_loads_into_a_table_dealt_by_key(dealt, make):
    stored, table = dealt
    batch = make(projects(random.Random(7), 100, (D2,)) + [{"queue_position": "1"}, {"queue_position": " "}], *S.PROJECT_COLUMNS)
    assert sorted(rows(table.read().select(*stored.columns)), key=repr) == sorted(rows(stored), key=repr)
    for day in (D1, D2, D3):
        got = table.upsert(batch, day)
        assert sorted(rows(got), key=repr) == sorted(rows(snapshots.upsert(stored, batch, day).select(*got.columns)), key=repr)
        dated = batch.withColumn(S.SNAPSHOT, F.lit(day))
        assert sorted(rows(table.superseded(dated).select(*stored.columns)), key=repr) == sorted(rows(snapshots.superseded(stored, dated)), key=repr)


def test_stored_rows_are_not_shuffled(spark, dealt, make):
    """No exchange between the stored files and the join, whatever the number of shuffle partitions."""
    _, table = dealt
    batch = make([{"queue_position": "1"}], *S.PROJECT_COLUMNS)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for partitions in ("3", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            for df in (table.upsert(batch, D2), table.superseded(batch.withColumn(S.SNAPSHOT, F.lit(D2)))):
                text = plan(df)
                join = next(k for k, line in enumerate(text.splitlines()) if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
                stored_side = text.splitlines()[join + 1:]
                scan = next(k for k, line in enumerate(stored_side) if "FileScan" in line)
                assert not any("Exchange" in line for line in stored_side[:scan]), text
                assert "Bucketed: true" in text and "SelectedBucketsCount: 8 out of 8" in text
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
