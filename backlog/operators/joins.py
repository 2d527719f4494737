"""Joining a skewed side to an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_per_key(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str, *also: Column) -> DataFrame:
    """Join `df`, in which some key may be very frequent, to an aggregate with one row per text key.

    Joined directly, the aggregate's own shuffle would feed the join, and adaptive execution only
    splits a hot partition when both sides come straight from a shuffle. Comparing with an
    expression of the aggregate's key gives it that: one more shuffle, of one row per key.
    """
    apart = [f"_{k}" for k in keys]
    values = [c for c in per_key.columns if c not in keys]
    right = per_key.select(
        *[F.concat(F.col(k), F.lit("")).alias(a) for k, a in zip(keys, apart)], *values
    )
    on = [F.col(k) == F.col(a) for k, a in zip(keys, apart)]
    return df.join(right, [*on, *also], how).drop(*apart)
