"""Keeping the snapshot history: upsert, retention, duplicates, load counts.

Every function takes `keys`: `queue_position` within one table, or status and position over the
stacked tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.functions.text import is_filled, with_values
from backlog.operators.joins import join_per_key
from backlog.operators.shape import drop_blank_keys

KEYS = (S.KEY,)


#: The newest incoming date of a row's key.
NEWEST = "_newest"


def newest_per_key(incoming: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key, combined before the shuffle, however often a key comes."""
    return incoming.groupBy(*keys).agg(F.max(S.SNAPSHOT).alias(NEWEST))


def with_newest(df: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All rows of `df`, with the newest date that their key comes in under."""
    return join_per_key(df, newest_per_key(incoming, keys), keys, "left")


def _older_rows(df: DataFrame, incoming: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of `df` whose key is incoming under a newer date: without them, or only them."""
    older = F.col(S.SNAPSHOT) < F.col(NEWEST)
    return join_per_key(df, newest_per_key(incoming, keys), keys, how, older)


def superseded(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The stored rows the incoming snapshot replaces by a newer date."""
    return _older_rows(existing, drop_blank_keys(incoming), keys, "left_semi")


def upsert(
    existing: DataFrame, incoming: DataFrame, snapshot_date: date, keys: Sequence[str] = KEYS
) -> DataFrame:
    """U1 for one snapshot: the table after loading it; loading it twice changes nothing.

    Rows of the same date are replaced, older rows of the same key go, newer ones stay, so a
    late file does no harm. Rows without a date belong to no snapshot and stay.
    """
    day = F.lit(snapshot_date)
    batch = drop_blank_keys(incoming).withColumn(S.SNAPSHOT, day)
    stored = existing.where(~F.col(S.SNAPSHOT).eqNullSafe(day))
    kept = _older_rows(stored, batch, keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def upsert_dated(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """U1 for rows of several snapshots at once: as if they were loaded one by one, oldest first.

    Incoming rows without a date belong to no snapshot and are not loaded.
    """
    batch = drop_blank_keys(incoming).where(F.col(S.SNAPSHOT).isNotNull())
    # One entry per day loaded; as a filter it prunes partitions, where a join by date would
    # shuffle the whole table onto a few dates.
    days = batch.select(F.collect_set(S.SNAPSHOT)).scalar()
    reloaded = F.coalesce(F.array_contains(days, F.col(S.SNAPSHOT)), F.lit(False))
    both = existing.where(~reloaded).unionByName(batch, allowMissingColumns=True)
    return _older_rows(both, batch, keys, "left_anti")


def retain(df: DataFrame, as_of: date, weeks: int = 52) -> DataFrame:
    """snapshots of the last weeks and those without a date."""
    oldest = F.date_sub(F.lit(as_of), 7 * weeks)
    return df.where(F.col(S.SNAPSHOT).isNull() | (F.col(S.SNAPSHOT) >= oldest))


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS, n: int = 10) -> DataFrame:
    """The n keys stored most often, of those stored more than once."""
    counts = with_values(df, *keys).groupBy(*keys).agg(F.count("*").alias("count"))
    return counts.where("count > 1").orderBy(F.desc("count"), *keys).limit(n)


def load_counts(
    existing: DataFrame, incoming: DataFrame, snapshot_date: date, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Rows read, dropped for a blank key, written, and stored rows of the same date replaced."""
    filled = F.count_if(F.coalesce(is_filled(F.col(S.KEY)), F.lit(False)))
    batch = incoming.agg(F.count("*").alias("rows_read"), filled.alias("rows_written")).select(
        "rows_read", (F.col("rows_read") - F.col("rows_written")).alias("rows_dropped"), "rows_written"
    )
    same_day = existing.where(F.col(S.SNAPSHOT) == F.lit(snapshot_date))
    replaced = same_day.agg(F.count("*"))
    gone = superseded(existing, incoming.withColumn(S.SNAPSHOT, F.lit(snapshot_date)), keys)
    return batch.select(
        "*",
        replaced.scalar().alias("rows_replaced"),
        gone.agg(F.count("*")).scalar().alias("rows_superseded"),
    )
