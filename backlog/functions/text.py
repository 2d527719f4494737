"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# `trim` only removes spaces; sheet cells also carry tabs, newlines and no-break spaces.
_WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def clean_text(c: Column) -> Column:
    """Text without white space at either end."""
    return F.btrim(c, F.lit(_WHITE_SPACE))


def is_filled(c: Column) -> Column:
    """neither null nor blank."""
    return c.isNotNull() & (clean_text(c.cast("string")) != "")


def join_filled(columns: Iterable[Column]) -> Column:
    """Non-empty values joined with `/`; `''` when there are none."""
    return F.concat_ws("/", *[F.nullif(c, F.lit("")) for c in columns])


def contains_any(c: Column, wanted: Iterable[str]) -> Column:
    """case-sensitive substring test against any of the given words; null is no match."""
    tests = [c.contains(w) for w in wanted]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def matches_search(c: Column, term: str) -> Column:
    """the term is a regular expression, found anywhere, in any case; null is no match."""
    return F.coalesce(c.rlike(f"(?i){term}"), F.lit(False))


def without_county_suffix(c: Column) -> Column:
    """County name without the word County, wherever and however it is written."""
    return clean_text(F.regexp_replace(c, "(?i) County", ""))


def whole_number_text(c: Column) -> Column:
    """A key that a spreadsheet turned into `1402.0` reads `1402` again."""
    return F.regexp_replace(c.cast("string"), r"^([0-9]+)\.0$", "$1")


def with_values(df: DataFrame, *columns: str) -> DataFrame:
    """rows with a value in every given column, as filters a scan can take over."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))
