"""Search in names and fuels by an inverted index of trigrams.

The index says which values hold a trigram; rows lie in parts by the hash of their value. A search works out the
trigrams that every match must hold, finds the values that hold them all, reads the parts these are in, and
verifies the values themselves. What has no such trigrams (alternatives, groups, fewer than three letters in a
row) is answered by a full scan. Letters A-Z are alike in any case, as in the search itself.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog.functions.text import contains_any, matches_search

SIZE = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One item of a plain expression, and how often it may come.
_ITEM = re.compile(r"(\[\^?\]?(?:\\.|[^\]\\])*\]|\\.|.)([*+?]|\{\d+(?:,\d*)?\})?[?+]?", re.S)
#: Groups and alternatives, quoted stretches and codes of characters, classes within classes: not plain to see.
_NOT_PLAIN = re.compile(r"[()|]|\\[a-zA-Z0-9](?<!\\[dDwWsSbBAzZ])|\[[^\]]*(?:\[|&&)")


def trigrams(text: str) -> set[str]:
    low = text.translate(str.maketrans(_UPPER, _LOWER))
    return {low[k:k + SIZE] for k in range(len(low) - SIZE + 1)}


def required(pattern: str) -> set[str]:
    """Trigrams that every match of a regular expression holds; none if that is not plain to see."""
    if _NOT_PLAIN.search(pattern):
        return set()
    runs, run, at = set(), "", 0
    while at < len(pattern):
        item = _ITEM.match(pattern, at)
        at = item.end()
        one, times = item[1], item[2]
        literal = one[1:] if one[0] == "\\" and len(one) == 2 and not one[1].isalnum() else one if len(one) == 1 and one not in ".^$" else None
        optional = times in ("*", "?") or (times or "").startswith("{0")
        if literal is not None and not optional:
            run += literal
        if literal is None or times:  # the run ends; a repeated letter may begin the next one
            runs.add(run)
            run = literal if literal is not None and not optional else ""
    return set().union(*map(trigrams, {*runs, run}))


def _grams(value: Column) -> Column:
    """The distinct trigrams of a value."""
    low = F.translate(value, _UPPER, _LOWER)
    starts = F.sequence(F.lit(1), F.greatest(F.length(low) - (SIZE - 1), F.lit(1)))
    return F.array_distinct(F.filter(F.transform(starts, lambda k: F.substring(low, k, F.lit(SIZE))), lambda g: F.length(g) == SIZE))


@dataclass(frozen=True)
class TextIndex:
    """Rows of a table below `path/rows`, in parts by `column`; which value holds which trigram below `path/grams`."""

    spark: SparkSession
    path: str
    column: str
    parts: int = 256

    def _part(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.parts)).cast("int")

    def write(self, rows: DataFrame) -> TextIndex:
        """Store the rows and their index. A value is split once, however many rows have it."""
        own = F.col(self.column)
        rows.withColumn("part", self._part(own)).repartition("part", F.pmod(F.xxhash64(*rows.columns), F.lit(8))).write.partitionBy("part").parquet(f"{self.path}/rows")
        values = rows.select(own.alias("value")).where(own.isNotNull()).distinct()
        grams = values.select("value", F.explode(_grams(F.col("value"))).alias("gram"))
        # Sorted, so that a file's statistics and row groups tell most trigrams away; a frequent one spans many files.
        grams.repartitionByRange("gram", "value").sortWithinPartitions("gram", "value").write.parquet(f"{self.path}/grams")
        return self

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def candidates(self, needed: Sequence[set[str]]) -> DataFrame:
        """(value) of the values that hold all trigrams of one of the sets."""
        wanted = sorted(set().union(*needed))
        held = self.spark.read.parquet(f"{self.path}/grams").where(F.col("gram").isin(wanted))
        sets = F.collect_set("gram")  # at most as many as are looked for
        found = held.groupBy("value").agg(sets.alias("grams"))
        tests = [F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in sorted(s)]))) == len(s) for s in needed]
        return found.where(reduce(Column.__or__, tests)).select("value")

    def _verified(self, needed: Sequence[set[str]], test: Column) -> DataFrame:
        rows = self.rows()
        if not needed or not all(needed):
            return rows.where(test).drop("part")
        found = self.candidates(needed).where(F.col("value").isNotNull())
        parts = [r[0] for r in found.select(self._part(F.col("value"))).distinct().collect()]  # at most as many as there are parts
        return rows.where(F.col("part").isin(parts)).where(test).drop("part")

    def search(self, pattern: str) -> DataFrame:
        """the rows whose value matches the expression, in any case."""
        return self._verified([required(pattern)], matches_search(F.col(self.column), pattern))

    def containing(self, words: Sequence[str]) -> DataFrame:
        """the rows whose value contains one of the words."""
        return self._verified([trigrams(w) for w in words], contains_any(F.col(self.column), words))
