"""Helpers that the operators share: shared folder, staged tables, Arrow maps that keep a table's columns."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Spark's setting to remove the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir; one of our own only where all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not f"{spark.sparkContext.master}[".startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs start from files, not from lineage."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(CLEANUP, None)
    # Spark else keeps the shuffle files of this write until the driver happens to collect its garbage.
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a task has as Python objects at once.
ROWS_AT_ONCE = 2_000


def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows: Spark's own hold 10,000, and texts take several times their bytes as Python strings."""
    return (batch.slice(k, ROWS_AT_ONCE) for batch in batches for k in range(0, batch.num_rows, ROWS_AT_ONCE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def released() -> None:
    """Give back what Arrow's pool holds for later: a worker stays on while others run, and Spark doesn't count it."""
    pa.default_memory_pool().release_unused()


def arrow_map(df: DataFrame, batches: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: T.StructType | str) -> DataFrame:
    """mapInArrow whose function yields dicts of columns; they get the types of `schema`."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    target = to_arrow_schema(schema)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in batches(source):
            arrays = [
                c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type, from_pandas=False)
                for c, f in ((columns[f.name], f) for f in target)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)
            released()

    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, of: list[str], per_batch: Callable[..., dict], added: dict[str, T.DataType]) -> DataFrame:
    """The table with further columns that `per_batch` works out from the lists of the columns `of`.

    All other columns pass through as they are, whatever their types. The new names must be free.
    """
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in added.items()]])
    places = [df.columns.index(c) for c in of]
    types = {f.name: f.type for f in to_arrow_schema(T.StructType([T.StructField(n, t) for n, t in added.items()]))}

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(source):
            new = per_batch(*[batch.column(i).to_pylist() for i in places])
            arrays = [pa.array(new[n], types[n]) for n in added]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *added])
            released()

    return df.mapInArrow(run, schema)


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """What `make` returned when this Python worker first asked for it; a worker runs many tasks."""
    kept = sys.modules.setdefault("_kept_per_worker", types.ModuleType("_kept_per_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)
