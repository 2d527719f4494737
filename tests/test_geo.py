import pytest
from helpers import plan, rows

from backlog.operators import geo


def located(spark, pairs, places=geo.FIXED_PLACES):
    df = spark.createDataFrame(pairs, "county string, state string")
    return rows(geo.with_coordinates(df, places).select("latitude", "longitude"))


def test_one_county_however_written(spark):
    pairs = [("KERN", "CA"), ("kern", "ca"), ("  Kern  ", " CA "), ("Kern County", "CA"), ("ROSAMOND", "CA")]
    assert set(located(spark, pairs)) == {(35.3425, -118.7299)}


def test_unknown_and_null(spark):
    pairs = [("INVALID_COUNTY", "CA"), (None, "CA"), ("KERN", None), ("", "CA"), ("CHURCH", "NV")]
    assert located(spark, pairs) == [(None, None)] * 5


def test_several_counties_are_averaged(spark):
    both, half = located(spark, [("KERN/RIVERSIDE", "CA"), ("Kern County / NOWHERE", "CA")])
    assert both == pytest.approx(((35.3425 + 33.9534) / 2, (-118.7299 - 117.3962) / 2))
    assert half == (35.3425, -118.7299)


def test_state_decides_between_counties_of_one_name(spark):
    got = located(spark, [("SANTA CRUZ", "CA"), ("SANTA CRUZ", "AZ"), ("LINCOLN", "NV"), ("LINCOLN", "ID")])
    assert got == [(36.9741, -122.0308), (31.5282, -110.8361), (37.6433, -114.8769), (42.9957, -114.1336)]


def test_name_alone_is_enough_when_the_state_does_not_fit(spark):
    got = located(spark, [("HYDER", "AZ"), ("CLARK/SAN BERNARDINO", "NV"), ("SAN BENITO", "NV")])
    assert got[0] == (42.9391, -114.7131)
    assert got[1] == pytest.approx(((36.2146 + 34.8414) / 2, (-115.0137 - 116.1781) / 2))
    assert got[2] == (36.6056, -121.0750)


def test_coordinates_off_the_globe_are_dropped(spark):
    dim = spark.createDataFrame([("XX", "FAR", 95.0, 10.0), ("XX", "NEAR", 9.0, 10.0)], geo._CENTROID_SCHEMA)
    assert located(spark, [("FAR", "XX"), ("NEAR", "XX")], geo.Places.of(dim)) == [(None, None), (9.0, 10.0)]


def test_a_long_list_of_places_is_joined_with_the_same_result(spark):
    many = [(f"S{i % 7}", f"PLACE {i}", i / 100, -i / 100) for i in range(2000)]
    dim = spark.createDataFrame(many, geo._CENTROID_SCHEMA)
    places = geo.Places.of(dim)
    assert places.listed is None
    pairs = [(f"place {i} county/PLACE {i + 1}", f"S{i % 7}") for i in range(0, 1990, 10)]
    many += [("CA", "SANTA CLARA", 1.0, 2.0), ("CA", "SAN CLARA", 3.0, 4.0), ("NV", "CHURCH", 5.0, 6.0)]
    dim = spark.createDataFrame(many, geo._CENTROID_SCHEMA)
    places = geo.Places.of(dim)
    pairs += [("San Clara", "CA"), ("San Clara", "NV"), ("CHURCH", "NV")]
    pairs += [("NOWHERE", "S1"), (None, "S1"), ("PLACE 3", None)] + [("PLACE 5", "S0")] * 500
    df = spark.createDataFrame(pairs, "county string, state string")
    joined = geo.with_coordinates(df, places)
    mapped = geo.with_coordinates(df, geo.Places(sorted(many)))
    columns = ["county", "state", "latitude", "longitude"]

    def shown(result):
        return sorted(
            [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(result.select(*columns))],
            key=repr,
        )

    assert shown(joined) == shown(mapped)
    assert joined.count() == len(pairs)


def test_a_short_list_needs_no_shuffle(spark):
    df = spark.createDataFrame([("KERN", "CA")], "county string, state string")
    text = plan(geo.with_coordinates(df).where("latitude is not null"))
    assert "Exchange" not in text and "Join" not in text
    assert text.count("aggregate(") == 1


def test_fixed_list(spark):
    dim = geo.county_centroids(spark)
    assert dim.count() == 103
    assert dim.select("state", "county").distinct().count() == 103


def test_coverage(spark):
    df = spark.createDataFrame([("KERN", "CA"), ("X", "CA"), (None, None)], "county string, state string")
    assert rows(geo.coordinate_coverage(geo.with_coordinates(df))) == [(3, 1, 2)]


def test_fixed_list_and_dimension_answer_alike(spark):
    """Names alone mean the last place listed, also in states that have none of that name."""
    pairs = [(c, s) for _, c, *_ in geo.COUNTY_CENTROIDS for s in ("CA", "OR", "ZZ")] + [(c, s) for s, c, *_ in geo.COUNTY_CENTROIDS]
    df = spark.createDataFrame(pairs, "county string, state string")
    columns = ["county", "state", "latitude", "longitude"]
    by_map, by_join = (
        sorted(rows(geo.with_coordinates(df, p).select(*columns))) for p in (geo.FIXED_PLACES, geo.Places.of(geo.county_centroids(spark)))
    )
    assert by_map == by_join
    last = {c: (lat, lon) for _, c, lat, lon in geo.COUNTY_CENTROIDS}
    assert {(c, (lat, lon)) for c, s, lat, lon in by_map if s == "ZZ" and c not in geo.COUNTY_FIXES} <= set(last.items())


def test_places_listed_twice_and_without_state(spark):
    listed = [("XX", "TWICE", 10.0, 1.0), ("XX", "TWICE", 20.0, 2.0), (None, "NOWHERE LAND", 5.0, 5.0)]
    dim = spark.createDataFrame([(*r, k) for k, r in enumerate(listed)], geo._CENTROID_SCHEMA + ", place_no int")
    for places in (geo.Places(listed), geo.Places.of(dim)):
        assert located(spark, [("TWICE", "XX")], places) == [(20.0, 2.0)]
        assert located(spark, [("Nowhere Land", "XX")], places) == [(5.0, 5.0)]
