"""Number expressions that never fail on dirty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a written number; Java would also take a trailing `d` or `f`.
_NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$"


def number_or_null(c: Column) -> Column:
    """P10: text or number as double; null when it is not one."""
    return F.when(c.cast("string").rlike(_NUMBER), c.try_cast("double"))


def safe_float(c: Column, default: float = 0.0) -> Column:
    """The value as double, else the default."""
    return F.coalesce(number_or_null(c), F.lit(float(default)))


def safe_int(c: Column, default: int = 0) -> Column:
    """Numbers lose their fraction, text must be a whole number, all else is the default."""
    return F.coalesce(c.try_cast("bigint"), F.lit(int(default)).cast("bigint"))


def format_mw(mw: Column) -> Column:
    """`1.23 GW` from a thousand up, else `999 MW`."""
    return F.when(
        mw >= 1000, F.concat(F.call_function("format_number", mw / 1000, F.lit("0.00")), F.lit(" GW"))
    ).otherwise(F.concat(F.call_function("format_number", mw, F.lit("0")), F.lit(" MW")))
