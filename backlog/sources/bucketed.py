"""Stored projects in a catalog table whose files are dealt by key.

Files are bucketed and sorted by the keys and a salt, so a load meets them bucket by bucket: the batch is shuffled,
one row per key and salt, and stored rows stay where they are. Without the shuffle a hot key can't be split at
run time, so its rows are spread over the salts when they are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog import schema as S
from backlog.operators.shape import drop_blank_keys
from backlog.operators.snapshots import KEYS, NEWEST, newest_per_key

SALT = "_salt"


@dataclass(frozen=True)
class BucketedTable:
    """A bucketed table of the session's catalog."""

    spark: SparkSession
    name: str
    keys: Sequence[str] = KEYS
    buckets: int = 64
    salts: int = 4

    def write(self, df: DataFrame, path: str) -> BucketedTable:
        """Make the table out of some rows, one file for each bucket, below `path`."""
        own = [*self.keys, SALT]
        salted = df.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(self.salts)).cast("int"))
        dealt = salted.repartition(self.buckets, *own)
        dealt.write.format("parquet").bucketBy(self.buckets, *own).sortBy(*own).option("path", path).saveAsTable(self.name)
        return self

    def _rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self._rows().drop(SALT)

    def _older(self, stored: DataFrame, batch: DataFrame, how: str) -> DataFrame:
        """Stored rows whose key is in the batch under a newer date: only them, or without them."""
        apart = {k: f"_{k}" for k in (*self.keys, SALT)}
        newest = newest_per_key(batch, self.keys).withColumnsRenamed(apart)
        each = newest.withColumn(apart[SALT], F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
        on = [F.col(k) == F.col(a) for k, a in apart.items()]
        return stored.join(each, [*on, F.col(S.SNAPSHOT) < F.col(NEWEST)], how).drop(SALT)

    def superseded(self, batch: DataFrame) -> DataFrame:
        """The stored rows that the batch replaces by a newer date."""
        return self._older(self._rows(), drop_blank_keys(batch), "left_semi")

    def upsert(self, batch: DataFrame, snapshot_date: date) -> DataFrame:
        """U1 for one snapshot, as `snapshots.upsert`."""
        day = F.lit(snapshot_date)
        dated = drop_blank_keys(batch).withColumn(S.SNAPSHOT, day)
        others = self._rows().where(~F.col(S.SNAPSHOT).eqNullSafe(day))
        return self._older(others, dated, "left_anti").unionByName(dated, allowMissingColumns=True)
