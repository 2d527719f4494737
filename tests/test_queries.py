"""Every registered query against its SQL in another engine, over the whole tables."""

import pytest
from compare import connect, differences
from helpers import TESTDATA

import __spark_entry__ as entry_points
from backlog.plans.oracle import all_sql
from backlog.plans.queries import all_queries

QUERIES = all_queries()
SQL = all_sql()
PATH = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(PATH)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, PATH), duck, SQL[name]) is None


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["fuel", "total_mw"]
    assert result.count() > 0


def test_star_keys_are_unique(spark):
    """Joins are left out on the ground that each adds one row per key."""
    for table, key in (("customer", "c_custkey"), ("nation", "n_nationkey"), ("region", "r_regionkey")):
        df = spark.read.parquet(f"{PATH}/{table}.parquet")
        assert df.select(key).distinct().count() == df.count()


def test_known_figures(spark):
    """Figures worked out beforehand for the 0.01 tables."""
    counts = {r.status: (r.project_count, r.total_mw) for r in QUERIES["status_counts"](spark, PATH).collect()}
    assert counts == {"Active": (413, 5547.0), "Completed": (453, 6187.0), "Withdrawn": (442, 5922.0)}
    summary = QUERIES["delay_summary"](spark, PATH).first()
    assert summary.median_delay_days == 145 and summary.min_delay_days == -2273
    assert (summary.positive_delay_count, summary.negative_delay_count) == (42, 37)
    assert QUERIES["dash_delay_by_fuel"](spark, PATH).count() == 166
    assert QUERIES["browse_projects"](spark, PATH).count() == 1829
    fuels = QUERIES["fuel_categories"](spark, PATH).collect()
    assert len(fuels) == 7 and fuels[0].fuel == ""


def test_identities(spark):
    """Active MW is the same by fuel and by status; delayed, early and unchanged are all rows."""
    by_fuel = QUERIES["capacity_by_fuel"](spark, PATH).agg({"total_mw": "sum"}).first()[0]
    active = QUERIES["status_counts"](spark, PATH).where("status = 'Active'").first().total_mw
    assert by_fuel == active
    s = QUERIES["delay_summary"](spark, PATH).first()
    detail = QUERIES["delay_detail"](spark, PATH).count()
    assert s.positive_delay_count + s.negative_delay_count + s.no_change_count == detail
