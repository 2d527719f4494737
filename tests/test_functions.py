import random

from helpers import at, rows
from pyspark.sql import functions as F

from backlog.functions import dates, labels, numbers, text


def one(spark, schema, values, *columns):
    return rows(spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema).select(*columns))


def test_clean_text_strips_what_python_strips(spark):
    values = ["  a b ", "\ta\n", " a ", "\x1ca\x85", "", " \r\n", None]
    got = one(spark, "v string", values, text.clean_text(F.col("v")))
    assert [g[0] for g in got] == [v.strip() if v is not None else None for v in values]


def test_is_filled(spark):
    got = one(spark, "v string", ["Z1", " ", "\n\t", "", None], text.is_filled(F.col("v")))
    assert [bool(g[0]) for g in got] == [True, False, False, False, False]


def test_join_filled(spark):
    values = [("Solar", None, "Wind"), ("", "Wind", None), (None, None, None), ("A/B", " ", "C")]
    got = one(spark, "a string, b string, c string", values, text.join_filled([F.col("a"), F.col("b"), F.col("c")]))
    assert [g[0] for g in got] == ["Solar/Wind", "Wind", "", "A/B/ /C"]


def test_contains_any_and_search(spark):
    values = ["Battery/Solar", "battery", "axb", None]
    got = one(
        spark, "v string", values,
        text.contains_any(F.col("v"), ["Solar", "Wind"]),
        text.contains_any(F.col("v"), ["Batt"]),
        text.matches_search(F.col("v"), "A.B"),
    )
    assert got == [(True, True, False), (False, False, False), (False, False, True), (False, False, False)]


def test_county_suffix(spark):
    values = ["Kern County", "KERN COUNTY ", "Inyo county/Mono County", None]
    got = one(spark, "v string", values, text.without_county_suffix(F.col("v")))
    assert [g[0] for g in got] == ["Kern", "KERN", "Inyo/Mono", None]


def test_whole_number_text(spark):
    got = one(spark, "v string", ["1402.0", "1402", "14.5", "C15-001", "WDT.0"], text.whole_number_text(F.col("v")))
    assert [g[0] for g in got] == ["1402", "1402", "14.5", "C15-001", "WDT.0"]


def test_days_are_floored_not_calendar(spark):
    pairs = [
        (at("2020-03-01 08:00:00"), at("2020-03-10 07:00:00")),  # one hour short of nine days
        (at("2020-03-01 07:00:00"), at("2020-03-10 08:00:00")),
        (at("2020-03-02 07:00:00"), at("2020-03-02 06:59:59")),  # a second early is a day early
        (at("2020-03-02 07:00:00"), at("2020-03-02 07:00:00")),
        (None, at("2020-03-02 07:00:00")),
    ]
    got = one(
        spark, "a timestamp_ntz, b timestamp_ntz", pairs,
        dates.days_between_floor(F.col("a"), F.col("b")),
        dates.seconds_between(F.col("a"), F.col("b")),
    )
    assert got == [(8, 774000.0), (9, 781200.0), (-1, -1.0), (0, 0.0), (None, None)]


def test_days_of_published_projects(spark):
    """Online dates at seven or eight o'clock, with the published days between them."""
    published = [
        ("2005-06-30 07:00:00", "2024-04-01 07:00:00", 6850),
        ("2007-09-01 07:00:00", "2030-10-31 07:00:00", 8461),
        ("2008-06-01 07:00:00", "2027-06-30 07:00:00", 6968),
        ("2006-05-31 07:00:00", "2023-02-28 08:00:00", 6117),
    ]
    got = one(
        spark, "a timestamp_ntz, b timestamp_ntz", [(at(a), at(b)) for a, b, _ in published],
        dates.days_between_floor(F.col("a"), F.col("b")),
    )
    assert [g[0] for g in got] == [days for *_, days in published]


def test_days_do_not_depend_on_the_session_zone(spark):
    pair = [(at("2021-03-13 12:00:00"), at("2021-03-14 12:00:00"))]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = one(spark, "a timestamp_ntz, b timestamp_ntz", pair, dates.days_between_floor(F.col("a"), F.col("b")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [(1,)]


def test_time_or_null(spark):
    values = ["2005-06-30 07:00:00", "2005-06-30", "6/3/2005", " 06/30/2005 7:05", "30.6.2005", "13/45/2005", "", None]
    got = one(spark, "v string", values, dates.time_or_null(F.col("v")))
    assert [g[0] for g in got] == [
        at("2005-06-30 07:00:00"), at("2005-06-30"), at("2005-06-03"), at("2005-06-30 07:05:00"), None, None, None, None,
    ]


def test_snapshot_date_of(spark):
    values = [
        "queue-report-06022025.csv", "cluster-15-requests-12312024.parquet", "queue-report.csv",
        "queue-report-13452025.csv", "queue-report-06022025", "a-06022025.d/part-0.csv",
    ]
    got = one(spark, "v string", values, dates.snapshot_date_of(F.col("v")).cast("string"))
    assert [g[0] for g in got] == ["2025-06-02", "2024-12-31", None, None, None, None]


def python_number(kind, value, default):
    try:
        return kind(value) if value is not None else default
    except ValueError:
        return default


def test_safe_casts_agree_with_python(spark):
    values = ["100.5", "100", " 7 ", "invalid", "", None, "1e3", "-3.", ".5", "12abc", "1.5d", "0x10", "--1"]
    got = one(
        spark, "v string", values, numbers.safe_float(F.col("v")), numbers.safe_float(F.col("v"), -1.5),
        numbers.safe_int(F.col("v"), 9),
    )
    assert got == [
        (python_number(float, v, 0.0), python_number(float, v, -1.5), python_number(int, v, 9)) for v in values
    ]


def test_safe_int_of_numbers_drops_the_fraction(spark):
    got = one(spark, "v double", [100.9, -100.9, None, float("nan")], numbers.safe_int(F.col("v")))
    assert [g[0] for g in got] == [100, -100, 0, 0]


def test_format_mw_rounds_like_python(spark):
    rng = random.Random(3)
    values = [rng.uniform(0, 5e4) for _ in range(500)] + [float(rng.randint(1000, 99999)) for _ in range(500)]
    values += [0.0, 0.5, 1.5, 2.5, 999.4, 999.5, 1000.0, 1005.0, 1125.0, 123456789.0]
    got = one(spark, "v double", values, numbers.format_mw(F.col("v")))
    want = [f"{v / 1000:.2f} GW" if v >= 1000 else f"{v:.0f} MW" for v in values]
    assert [g[0] for g in got] == want


def test_study_labels(spark):
    values = ["C14", "C1X", "C", "Serial LGIP", "TC", "ISP", "FT", "SGIP-TC", "Other"]
    got = one(spark, "v string", values, labels.study_label(F.col("v")))
    assert [g[0] for g in got] == [
        "C14 (Cluster 14)", "C1X", "C", "Serial LGIP (Standard LGIP)", "TC (Transition Cluster)",
        "ISP (Independent Study Process)", "FT (Fast Track)", "SGIP-TC (Small Generator)", "Other",
    ]


def test_study_order(spark):
    values = ["TC", "C14", "C2", "C010", "ISP", "C01", "C1", "AMENDMENT 39"]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    got = [r[0] for r in df.orderBy(*labels.study_order(F.col("v"))).collect()]
    assert got == ["C01", "C1", "C2", "C010", "C14", "AMENDMENT 39", "ISP", "TC"]


def test_place_label(spark):
    got = one(
        spark, "c string, s string, n bigint, mw double", [("Kern", "CA", 3, 1500.0)],
        labels.place_label(F.col("c"), F.col("s"), F.col("n"), F.col("mw")),
    )
    assert got == [("Kern County, CA<br>Projects: 3<br>Total Capacity: 1.50 GW",)]
