"""CSV output."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single_file: bool = False, order: Sequence[str] = ()) -> None:
    """A folder of CSV files with a header; one file, sorted, for results that are small by nature.

    Text keeps its blanks, and quotes in it are doubled. The files are written aside and take the folder's name when
    all are there, so a reader sees the report of before or the new one; where writing fails, the former stays.
    """
    if single_file:
        # Repartitioned, not coalesced: the work before it stays spread over the cluster.
        df = df.repartition(1)
    if order:
        df = df.sortWithinPartitions(*order)
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    # Names with an underscore are passed over by readers of the folder above.
    above, _, name = path.rstrip("/").rpartition("/")
    aside, former = (f"{above}/_{name}-{uuid.uuid4().hex}" for _ in range(2))
    df.write.options(header=True, **kept).csv(aside)
    _published(df, aside, path, former)


def _published(df: DataFrame, aside: str, path: str, former: str) -> None:
    """Give the folder `aside` the name `path`."""
    session = df.sparkSession
    new, own, old = (session._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path, former))
    files = own.getFileSystem(session._jsc.hadoopConfiguration())
    if files.exists(own) and not files.rename(own, old):
        raise OSError(f"{path} can't be replaced")
    if not files.rename(new, own):
        raise OSError(f"{aside} can't be renamed to {path}")
    files.delete(old, True)
