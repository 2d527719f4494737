"""Labels and ordering of study processes, and the map label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from backlog.functions.numbers import format_mw

# What the named study processes stand for.
PROCESS_NAMES = {
    "Serial LGIP": "Standard LGIP",
    "TC": "Transition Cluster",
    "ISP": "Independent Study Process",
    "FT": "Fast Track",
}


def cluster_number(process: Column) -> Column:
    """14 for `C14` and `C014`; null for everything that is not a cluster code."""
    return F.nullif(F.regexp_extract(process, "^C0*([0-9]+)$", 1), F.lit("")).try_cast("bigint")


def study_order(process: Column) -> list[Column]:
    """T5: cluster codes first, by number, then the other processes by name."""
    number = cluster_number(process)
    return [number.asc_nulls_last(), process.asc()]


def study_label(process: Column) -> Column:
    """The process with its meaning in brackets."""
    label = F.when(
        process.rlike("^C[0-9]+$"),
        F.concat(process, F.lit(" (Cluster "), F.regexp_replace(process, "^C", ""), F.lit(")")),
    )
    for name, meaning in PROCESS_NAMES.items():
        label = label.when(process == name, F.lit(f"{name} ({meaning})"))
    return label.when(
        process.startswith("SGIP"), F.concat(process, F.lit(" (Small Generator)"))
    ).otherwise(process)


def place_label(county: Column, state: Column, projects: Column, capacity: Column) -> Column:
    """The text shown for one place on a map."""
    # The wording of the label.
    return F.concat(
        county, F.lit(" County, "), state,
        F.lit("<br>Projects: "), projects.cast("string"),
        F.lit("<br>Total Capacity: "), format_mw(capacity),
    )
