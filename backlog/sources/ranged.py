"""Projects laid out by date and MW, so that questions for the newest or the largest skip files.

Rows are dealt to files by ranges of date and MW; a day of any size, and an MW that very many projects have, spread
over as many files as they need. Beside the rows lies one row for each file with its least and greatest date and MW.
A question picks its files by these; within a file, sorted rows let the scan skip row groups as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog import schema as S

#: Bytes of a row group; small ones, as each can be skipped.
ROW_GROUP = 8 << 20


@dataclass(frozen=True)
class RangedTable:
    """Rows below `path/rows`, one row for each file of theirs below `path/files`."""

    spark: SparkSession
    path: str
    measure: str = "net_mw"

    def write(self, df: DataFrame, files: int) -> RangedTable:
        """Lay out some rows in about so many files."""
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        order = [F.desc_nulls_last(S.SNAPSHOT), F.desc_nulls_last(self.measure), spread]
        dealt = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
        dealt.write.option("parquet.block.size", ROW_GROUP).parquet(f"{self.path}/rows")
        rows = self.spark.read.parquet(f"{self.path}/rows").select(S.SNAPSHOT, self.measure, F.col("_metadata.file_path").alias("file"))
        rows.groupBy("file").agg(
            F.max(S.SNAPSHOT).alias("newest"), F.min(self.measure).alias("least"), F.max(self.measure).alias("most"), F.count(self.measure).alias("n"),
        ).repartition(1).write.parquet(f"{self.path}/files")
        return self

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def _files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/files")

    def _from(self, files: Sequence[str]) -> DataFrame:
        rows = self.read()
        return self.spark.read.schema(rows.schema).parquet(*files) if files else rows.limit(0)

    def latest(self) -> DataFrame:
        """the rows of the newest date, from the files that have it."""
        newest = self._files().agg(F.max("newest")).first()[0]
        files = [r.file for r in self._files().where(F.col("newest") == F.lit(newest)).collect()] if newest else []  # one row a file
        return self._from(files).where(F.col(S.SNAPSHOT) == F.lit(newest))

    def at_least(self, measure: float) -> DataFrame:
        """F8: the rows of so many MW at least, from the files that have any."""
        files = [r.file for r in self._files().where(F.col("most") >= measure).collect()]
        return self._from(files).where(F.col(self.measure) >= measure)

    def largest(self, n: int, *order: str) -> DataFrame:
        """The n rows of most MW, equal ones by `order`.

        The files of the largest least MW hold n rows between them; nothing below that can be among the first n.
        """
        held, floor = 0, float("-inf")
        for file in self._files().where("n > 0").orderBy(F.desc("least")).collect():
            held, floor = held + file.n, file.least
            if held >= n:
                break
        return self.at_least(floor).orderBy(F.desc(self.measure), *[F.asc_nulls_first(c) for c in order]).limit(n)
