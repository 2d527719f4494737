"""Date expressions. Timestamps are zone-less, so none of this depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_or_null(c: Column) -> Column:
    """Text as a zone-less timestamp; `2005-06-30 07:00` or `6/30/2005`, else null."""
    iso = F.regexp_replace(c.cast("string"), r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
    return iso.try_cast("timestamp_ntz")


def _elapsed_seconds(start: Column, end: Column) -> Column:
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return span.cast("interval second").cast("decimal(18,6)")


def days_between_floor(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down; an hour short of a day is no day.

    Not `datediff`, which counts calendar days and is off by one whenever the clock moved.
    """
    seconds = F.floor(_elapsed_seconds(start, end)).cast("bigint")
    return F.floor(seconds / F.lit(86400)).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end; whole numbers, so their sums are exact in any order."""
    return _elapsed_seconds(start, end).cast("double")


def snapshot_date_of(file_name: Column) -> Column:
    """The date in a `name-MMDDYYYY.ext` file name; null where there is none."""
    digits = F.regexp_extract(file_name, r"-([0-9]{8})\.[^./]*$", 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), "MMddyyyy")
