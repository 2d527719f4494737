"""Places on a map at every zoom (A14, B3): cells that are cut into four at each level, rolled up at once.

Level 0 is the whole map; a cell's key is that of the cell around it and one more digit, so the cells of a level are
the prefixes of one length. The last level is that of the places themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backlog.operators.browse import location_rollup

PLACE = ("county", "state", "latitude", "longitude")
LEVELS = 8


def cell_key(latitude: Column, longitude: Column, level: int) -> Column:
    """The key of a place's cell: a digit for each level, 0 to 3, west to east and then north to south."""
    if level == 0:
        return F.lit("")
    n = 1 << level
    x = F.least(F.floor((longitude + 180) / 360 * n), F.lit(n - 1))
    y = F.least(F.floor((90 - latitude) / 180 * n), F.lit(n - 1))
    bit = lambda c, k: F.shiftright(c, k).bitwiseAND(F.lit(1))
    return F.concat(*[(bit(x, k) + 2 * bit(y, k)).cast("string") for k in range(level - 1, -1, -1)])


def zoom_rollup(locations: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(level, cell, places, project_count, total_capacity, latitude, longitude): every cell that holds a place.

    Projects are added up per place first; the cells of all levels come from those few rows. A cell's latitude and
    longitude are the means of its places', by projects.
    """
    places = location_rollup(locations).where(F.col("project_count") > 0)
    finest = places.withColumn("key", cell_key(F.col("latitude"), F.col("longitude"), levels))
    each = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    cells = finest.withColumn("level", each).withColumn("cell", F.substring("key", F.lit(1), F.col("level")))
    weighted = {c: (F.sum(F.col(c) * F.col("project_count")) / F.sum("project_count")).alias(c) for c in ("latitude", "longitude")}
    return cells.groupBy("level", "cell").agg(
        F.count("*").alias("places"), F.sum("project_count").alias("project_count"), F.sum("total_capacity").alias("total_capacity"), *weighted.values()
    )
