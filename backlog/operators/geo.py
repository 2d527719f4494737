"""County centroids: the fixed list, and the two ways to attach coordinates.

A county is looked up by state and name. When the state does not fit (a row may list
counties of two states under one state code) its name alone decides.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog.functions.text import clean_text, with_values
from backlog.operators.joins import join_per_key

# State, county, latitude, longitude.
COUNTY_CENTROIDS = [
    ("CA", "ALAMEDA", 37.6017, -121.7195),
    ("CA", "ALPINE", 38.5898, -119.8208),
    ("CA", "AMADOR", 38.4464, -120.6529),
    ("CA", "BUTTE", 39.6679, -121.6008),
    ("CA", "CALAVERAS", 38.2041, -120.5547),
    ("CA", "COLUSA", 39.1776, -122.2375),
    ("CA", "CONTRA COSTA", 37.9194, -121.9275),
    ("CA", "DEL NORTE", 41.6029, -123.7458),
    ("CA", "EL DORADO", 38.7786, -120.5246),
    ("CA", "FRESNO", 36.7378, -119.7871),
    ("CA", "GLENN", 39.5984, -122.3921),
    ("CA", "HUMBOLDT", 40.7075, -123.8692),
    ("CA", "IMPERIAL", 33.0395, -115.3597),
    ("CA", "INYO", 36.5111, -117.4107),
    ("CA", "KERN", 35.3425, -118.7299),
    ("CA", "KINGS", 36.0753, -119.8156),
    ("CA", "LAKE", 39.0997, -122.7532),
    ("CA", "LASSEN", 40.6736, -120.5946),
    ("CA", "LOS ANGELES", 34.3200, -118.2250),
    ("CA", "MADERA", 37.2181, -119.7626),
    ("CA", "MARIN", 37.9034, -122.5552),
    ("CA", "MARIPOSA", 37.5708, -119.9052),
    ("CA", "MENDOCINO", 39.4407, -123.3915),
    ("CA", "MERCED", 37.1911, -120.7179),
    ("CA", "MODOC", 41.5897, -120.7250),
    ("CA", "MONO", 37.9389, -118.8870),
    ("CA", "MONTEREY", 36.6002, -121.8947),
    ("CA", "NAPA", 38.5025, -122.2654),
    ("CA", "NEVADA", 39.3012, -120.7686),
    ("CA", "ORANGE", 33.7175, -117.8311),
    ("CA", "PLACER", 39.0639, -120.7179),
    ("CA", "PLUMAS", 40.0037, -120.8397),
    ("CA", "RIVERSIDE", 33.9534, -117.3962),
    ("CA", "SACRAMENTO", 38.5816, -121.4944),
    ("CA", "SAN BENITO", 36.6056, -121.0750),
    ("CA", "SAN BERNARDINO", 34.8414, -116.1781),
    ("CA", "SAN DIEGO", 32.7157, -117.1611),
    ("CA", "SAN FRANCISCO", 37.7749, -122.4194),
    ("CA", "SAN JOAQUIN", 37.9349, -121.2713),
    ("CA", "SAN LUIS OBISPO", 35.3102, -120.4358),
    ("CA", "SAN MATEO", 37.4969, -122.3330),
    ("CA", "SANTA BARBARA", 34.4208, -119.6982),
    ("CA", "SANTA CLARA", 37.3541, -121.9552),
    ("CA", "SANTA CRUZ", 36.9741, -122.0308),
    ("CA", "SHASTA", 40.5865, -122.3916),
    ("CA", "SIERRA", 39.5807, -120.5166),
    ("CA", "SISKIYOU", 41.5928, -122.5405),
    ("CA", "SOLANO", 38.2884, -121.9497),
    ("CA", "SONOMA", 38.5270, -122.9285),
    ("CA", "STANISLAUS", 37.5591, -120.9979),
    ("CA", "SUTTER", 39.0342, -121.6948),
    ("CA", "TEHAMA", 40.1255, -122.2347),
    ("CA", "TRINITY", 40.6507, -123.1126),
    ("CA", "TULARE", 36.2077, -119.3473),
    ("CA", "TUOLUMNE", 38.0276, -120.2326),
    ("CA", "VENTURA", 34.3705, -119.1390),
    ("CA", "YOLO", 38.6865, -121.9017),
    ("CA", "YUBA", 39.2685, -121.3519),
    ("AZ", "YUMA", 32.6927, -114.6277),
    ("AZ", "MOHAVE", 35.7047, -113.7578),
    ("AZ", "LA PAZ", 33.7295, -113.9814),
    ("AZ", "MARICOPA", 33.5102, -112.0901),
    ("AZ", "PINAL", 32.9042, -111.3447),
    ("AZ", "GILA", 33.8003, -110.8127),
    ("AZ", "GRAHAM", 32.9319, -109.8875),
    ("AZ", "GREENLEE", 33.2151, -109.2402),
    ("AZ", "COCHISE", 31.8798, -109.7513),
    ("AZ", "SANTA CRUZ", 31.5282, -110.8361),
    ("AZ", "PIMA", 32.2217, -110.9265),
    ("NV", "CLARK", 36.2146, -115.0137),
    ("NV", "LINCOLN", 37.6433, -114.8769),
    ("NV", "NYE", 38.0423, -116.4727),
    ("NV", "ESMERALDA", 37.7847, -117.6322),
    ("NV", "MINERAL", 38.5383, -118.4351),
    ("NV", "DOUGLAS", 38.9121, -119.6163),
    ("NV", "CARSON CITY", 39.1638, -119.7674),
    ("NV", "WASHOE", 40.8386, -119.7528),
    ("NV", "PERSHING", 40.4489, -118.4047),
    ("NV", "HUMBOLDT", 41.4061, -118.1126),
    ("NV", "ELKO", 41.1265, -115.3517),
    ("NV", "EUREKA", 39.9841, -116.1786),
    ("NV", "LANDER", 39.5708, -117.0705),
    ("NV", "WHITE PINE", 39.4420, -114.8986),
    ("ID", "LINCOLN", 42.9957, -114.1336),
    ("ID", "TWIN FALLS", 42.3566, -114.6681),
    ("ID", "GOODING", 42.9391, -114.7131),
    ("ID", "JEROME", 42.6897, -114.2636),
    ("ID", "MINIDOKA", 42.8549, -113.6375),
    ("ID", "CASSIA", 42.2838, -113.6011),
    ("ID", "ONEIDA", 42.1958, -112.5411),
    ("ID", "POWER", 42.6938, -112.8408),
    ("ID", "BANNOCK", 42.6685, -112.2158),
    ("ID", "CARIBOU", 42.7705, -111.5622),
    ("WY", "PLATTE", 42.1330, -104.9658),
    ("WY", "SWEETWATER", 41.6595, -108.8796),
    ("WY", "CARBON", 41.6945, -106.9306),
    ("WY", "ALBANY", 41.6545, -105.7236),
    ("WY", "LARAMIE", 41.3072, -104.6902),
    ("WY", "GOSHEN", 42.0879, -104.3533),
    ("WY", "NIOBRARA", 43.0564, -104.4752),
    ("WY", "WESTON", 43.8405, -104.5677),
    ("WY", "CROOK", 44.5885, -104.5702),
    ("WY", "CAMPBELL", 44.2483, -105.5483),
]

# Misspelt or local names and the county they mean.
COUNTY_FIXES = {
    "SAN BERNADINO": "SAN BERNARDINO",
    "SAN CLARA": "SANTA CLARA",
    "MOJAVE": "MOHAVE",
    "CHURCH": "CHURCHILL",
    "TECATE BAJA CALIFORNIA MEXICO": "TECATE",
    "ROSAMOND": "KERN",
    "HYDER": "GOODING",
}

_MAP_TYPE = "map<string,struct<lat:double,lon:double>>"
_CENTROID_SCHEMA = "state string, county string, lat double, lon double"


@dataclass(frozen=True)
class Places:
    """Known places: the fixed list, which is a constant of the plan, or a dimension to join.

    Both answer alike. A place listed twice counts as last listed, and a name in a state that is not
    listed means the last place of that name. The order of a dimension is its `place_no`, or else that
    of its rows' values.
    """

    listed: list[tuple[str | None, str, float, float]] | None
    dimension: DataFrame | None = None

    @classmethod
    def of(cls, dimension: DataFrame) -> Places:
        return cls(None, dimension)


FIXED_PLACES = Places(COUNTY_CENTROIDS)


def county_centroids(spark: SparkSession) -> DataFrame:
    """The fixed list as a dimension `(state, county, lat, lon, place_no)`."""
    rows = [(*place, number) for number, place in enumerate(COUNTY_CENTROIDS)]
    return spark.createDataFrame(rows, f"{_CENTROID_SCHEMA}, place_no int")


def _literal_map(entries: dict) -> Column:
    """One constant, folded at planning time; building it key by key would be 200 calls."""
    text = json.dumps({k: {"lat": lat, "lon": lon} for k, (lat, lon) in entries.items()})
    return F.from_json(F.lit(text), _MAP_TYPE)


def _county_name(part: Column) -> Column:
    """`' kern county '` -> `'KERN'`."""
    return clean_text(F.replace(clean_text(F.upper(part)), F.lit(" COUNTY"), F.lit("")))


def county_names(county: Column) -> Column:
    """`' kern county/Mojave'` -> `['KERN', 'MOJAVE']`."""
    return F.transform(F.split(county, "/"), _county_name)


def _meant(name: Column) -> Column:
    """The county a written name means."""
    fixes = F.create_map(*[F.lit(x) for pair in COUNTY_FIXES.items() for x in pair])
    return F.coalesce(F.try_element_at(fixes, name), name)


def _with_written_names(places: dict, prefix: str = "") -> dict:
    """A lookup by meant name, made one by written name, so rows need no step between."""
    written = dict(places)
    for name, meant in COUNTY_FIXES.items():
        written.pop(prefix + name, None)
        if prefix + meant in places:
            written[prefix + name] = places[prefix + meant]
    return written


def _state_key(state: Column) -> Column:
    return F.upper(clean_text(state))


def _valid(lat: Column, lon: Column) -> Column:
    return lat.between(-90, 90) & lon.between(-180, 180)


def _centroid_from_map(county: Column, state: Column, places: list) -> Column:
    """Mean of the known parts as `lat, lon`; both null when no part is known."""
    in_state = {f"{s.upper()}|{c.upper()}": (lat, lon) for s, c, lat, lon in places if s is not None}
    for prefix in {f"{s.upper()}|" for s, *_ in places if s is not None}:
        in_state = _with_written_names(in_state, prefix)
    exact = _literal_map(in_state)
    by_name = _literal_map(_with_written_names({c.upper(): (lat, lon) for _, c, lat, lon in places}))
    state_name = _state_key(state)

    def find(part: Column) -> Column:
        return F.coalesce(
            F.try_element_at(exact, F.concat(state_name, F.lit("|"), part)),
            F.try_element_at(by_name, part),
        )

    found = F.filter(F.transform(county_names(county), find), lambda place: place.isNotNull())
    start = F.struct(F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("n"))

    def add(total: Column, place: Column) -> Column:
        return F.struct(
            (total["lat"] + place["lat"]).alias("lat"),
            (total["lon"] + place["lon"]).alias("lon"),
            (total["n"] + 1.0).alias("n"),
        )

    def mean(total: Column) -> Column:
        return F.struct(
            F.try_divide(total["lat"], total["n"]).alias("lat"),
            F.try_divide(total["lon"], total["n"]).alias("lon"),
        )

    nowhere = F.struct(
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon")
    )
    known = county.isNotNull() & state.isNotNull()
    # Most texts name one county, which needs no array.
    return (
        F.when(known & ~county.contains("/"), find(_county_name(county)))
        .when(known, F.aggregate(found, start, add, mean))
        .otherwise(nowhere)
    )


def centroids_of_pairs(pairs: DataFrame, dimension: DataFrame, county: str, state: str) -> DataFrame:
    """J1 as joins, for a dimension of any size: one row per pair with `latitude, longitude`.

    The pairs are made distinct before they are split, so what is shuffled is the number of
    different texts, not the number of projects.
    """
    order = "place_no" if "place_no" in dimension.columns else F.struct("state", "county", "lat", "lon")
    ordered = dimension.select(
        F.upper("state").alias("d_state"), F.upper("county").alias("d_county"),
        F.struct("lat", "lon").alias("place"), F.struct(order).alias("place_order"),
    )
    last = F.max_by("place", "place_order")
    dim = ordered.groupBy("d_state", "d_county").agg(last.alias("d")).select("d_state", "d_county", "d.*")
    by_name = ordered.groupBy(F.col("d_county").alias("n_county")).agg(last.alias("n"))
    distinct = with_values(pairs.select(county, state), county, state).distinct()
    written = distinct.select(county, state, F.explode(county_names(F.col(county))).alias("part"))
    parts = written.withColumn("part", _meant(F.col("part")))
    exact = (F.col("part") == F.col("d_county")) & (_state_key(F.col(state)) == F.col("d_state"))
    located = (
        parts.join(dim, exact, "left")
        .join(by_name, F.col("part") == F.col("n_county"), "left")
        .withColumns({
            "lat": F.coalesce(F.col("lat"), F.col("n.lat")),
            "lon": F.coalesce(F.col("lon"), F.col("n.lon")),
        })
    )
    means = located.groupBy(county, state).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    ok = _valid(F.col("lat"), F.col("lon"))
    return means.select(
        county, state,
        F.when(ok, F.col("lat")).alias("latitude"),
        F.when(ok, F.col("lon")).alias("longitude"),
    )


def with_coordinates(df: DataFrame, places: Places = FIXED_PLACES) -> DataFrame:
    """Add `latitude, longitude` of `county, state`; unknown places and null keys stay null.

    The fixed list is a constant map: every row is answered where it lies, without a shuffle. A
    dimension, whatever its size, is joined to the distinct pairs.
    """
    if places.listed is None:
        located = centroids_of_pairs(df, places.dimension, "county", "state")
        return join_per_key(df.drop("latitude", "longitude"), located, ["county", "state"], "left")
    centre = _centroid_from_map(F.col("county"), F.col("state"), places.listed)
    # A generator, not a projection: a filter on the coordinates then stays above it, where a
    # projected expression would be copied into the filter and worked out once per mention.
    located = df.drop("latitude", "longitude").select("*", F.inline(F.array(centre)))
    ok = _valid(F.col("lat"), F.col("lon"))
    return located.withColumns({
        "latitude": F.when(ok, F.col("lat")),
        "longitude": F.when(ok, F.col("lon")),
    }).drop("lat", "lon")


def coordinate_coverage(df: DataFrame) -> DataFrame:
    """Rows in all, with and without coordinates."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("latitude").isNotNull()).alias("with_coordinates"),
        F.count_if(F.col("latitude").isNull()).alias("without_coordinates"),
    )
