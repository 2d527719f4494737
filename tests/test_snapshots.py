import random
from datetime import date, timedelta

import pytest
from helpers import rows

from backlog.operators import snapshots

D1, D2, D3 = date(2025, 1, 6), date(2025, 1, 13), date(2025, 1, 20)
COLUMNS = ("queue_position", "ingestion_date", "net_mw")


@pytest.fixture(scope="module")
def stored(spark):
    def build(records):
        return spark.createDataFrame(records, "queue_position string, ingestion_date date, net_mw double")

    return build


def load_one(table, batch, day):
    """The rule in plain Python: replace the day, drop older rows of the batch's keys, append."""
    batch = [(k, day, v) for k, d, v in batch if k is not None and k.strip()]
    keys = {k for k, _, _ in batch}
    kept = [r for r in table if r[1] != day and not (r[0] in keys and r[1] is not None and r[1] < day)]
    return kept + batch


def same(df, records):
    assert sorted(rows(df.select(*COLUMNS)), key=repr) == sorted(records, key=repr)


def test_upsert_supersedes_older_rows_only(stored):
    existing = [("A", D1, 1.0), ("B", D1, 2.0), ("A", D3, 9.0), ("C", D2, 3.0), ("D", None, 4.0), (None, D1, 5.0)]
    incoming = [("A", D2, 10.0), ("D", D2, 40.0), ("A", D2, 11.0), (" ", D2, 0.0), (None, D2, 0.0)]
    result = snapshots.upsert(stored(existing), stored(incoming), D2)
    same(result, [
        ("B", D1, 2.0), ("A", D3, 9.0), ("D", None, 4.0), (None, D1, 5.0),
        ("A", D2, 10.0), ("A", D2, 11.0), ("D", D2, 40.0),
    ])
    same(result, load_one(existing, incoming, D2))


def test_upsert_twice_is_upsert_once(stored):
    existing, incoming = stored([("A", D1, 1.0), ("B", D1, 2.0)]), stored([("A", D2, 3.0)])
    once = snapshots.upsert(existing, incoming, D2)
    assert sorted(rows(snapshots.upsert(once, incoming, D2))) == sorted(rows(once))


def random_records(rng, days, n, hot=0.0):
    keys = [None, " ", *[f"Z{i}" for i in range(12)]]
    return [
        ("HOT" if rng.random() < hot else rng.choice(keys), rng.choice(days), float(rng.randint(0, 99)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_batches_equal_loading_one_by_one(stored, seed):
    rng = random.Random(seed)
    days = [D1 + timedelta(weeks=i) for i in range(6)]
    existing = [r for r in random_records(rng, [*days, None], 80, 0.3) if r[0] and r[0].strip()]
    incoming = random_records(rng, days[2:5], 60, 0.3)
    want = existing
    for day in sorted({r[1] for r in incoming if r[0] and r[0].strip()}):
        want = load_one(want, [r for r in incoming if r[1] == day], day)
    same(snapshots.upsert_dated(stored(existing), stored(incoming)), want)


@pytest.mark.parametrize("seed", range(3))
def test_single_loads_equal_brute_force(stored, seed):
    rng = random.Random(100 + seed)
    days = [D1 + timedelta(weeks=i) for i in range(5)]
    existing = random_records(rng, [*days, None], 90, 0.4)
    incoming = random_records(rng, days[2:3], 40, 0.4)
    same(snapshots.upsert(stored(existing), stored(incoming), days[2]), load_one(existing, incoming, days[2]))


def test_undated_incoming_rows_are_not_loaded(stored):
    existing = [("A", D1, 1.0), ("B", None, 2.0)]
    incoming = [("A", None, 5.0), ("C", None, 6.0), ("D", D2, 7.0)]
    once = snapshots.upsert_dated(stored(existing), stored(incoming))
    same(once, [*existing, ("D", D2, 7.0)])
    same(snapshots.upsert_dated(once, stored(incoming)), [*existing, ("D", D2, 7.0)])


def test_per_table_keys(spark):
    schema = "status string, queue_position string, ingestion_date date"
    existing = spark.createDataFrame([("Active", "A", D1), ("Completed", "A", D1)], schema)
    incoming = spark.createDataFrame([("Active", "A", D2)], schema)
    got = snapshots.upsert(existing, incoming, D2, ("status", "queue_position"))
    assert sorted(rows(got.select("status", "ingestion_date"))) == [("Active", D2), ("Completed", D1)]


def test_superseded_and_load_counts(stored):
    existing = stored([("A", D1, 1.0), ("A", D2, 1.0), ("B", D1, 1.0), ("C", D1, 1.0)])
    incoming = stored([("A", D2, 1.0), ("B", D2, 1.0), (" ", D2, 1.0), (None, D2, 1.0)])
    same(snapshots.superseded(existing, incoming), [("A", D1, 1.0), ("B", D1, 1.0)])
    counts = snapshots.load_counts(existing, incoming, D2).first()
    assert counts.asDict() == {
        "rows_read": 4, "rows_dropped": 2, "rows_written": 2, "rows_replaced": 1, "rows_superseded": 2,
    }
    after = snapshots.upsert(existing, incoming, D2)
    assert snapshots.superseded(after, incoming).count() == 0


def test_retention_is_52_weeks(stored):
    today = date(2025, 6, 2)
    ages = {"60w": 420, "53w": 371, "edge+1": 365, "edge": 364, "50w": 350, "1d": 1}
    records = [(k, today - timedelta(days=d), 0.0) for k, d in ages.items()] + [("undated", None, 0.0)]
    kept = {r[0] for r in rows(snapshots.retain(stored(records), today))}
    assert kept == {"edge", "50w", "1d", "undated"}


def test_duplicates(stored):
    df = stored([("Z001", D1, 0.0), ("Z002", D1, 0.0), ("Z001", D2, 0.0), (None, D1, 0.0), (None, D2, 0.0)])
    assert rows(snapshots.duplicate_keys(df)) == [("Z001", 2)]
    many = stored([(f"K{i:02d}", D1, 0.0) for i in range(15) for _ in range(1 + i % 4)])
    top = rows(snapshots.duplicate_keys(many, n=3))
    assert top == [("K03", 4), ("K07", 4), ("K11", 4)]


def test_a_hot_key_keeps_all_its_rows(spark, stored):
    """A third of all rows under one key, that the batch does not touch."""
    existing = stored([("HOT" if i % 3 == 0 else f"K{i}", D1, float(i)) for i in range(3000)])
    incoming = stored([(f"K{i}", D2, 0.0) for i in range(0, 3000, 2)])
    result = snapshots.upsert(existing, incoming, D2)
    assert result.where("queue_position = 'HOT'").count() == 1000
    assert result.count() == len(load_one(rows(existing), rows(incoming), D2))
