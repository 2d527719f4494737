"""Incremental load of newly landed snapshot files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from backlog.operators.shape import shape_snapshot
from backlog.sources.sheets import FILE_NAME, file_date, read_landed
from backlog.sources.store import StoredTable, incoming_rows

#: Files of a batch at most.
FILES = 1_000
FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    headers: Sequence[str],
    table: StoredTable,
    checkpoint: str | None = None,
    files: int = FILES,
) -> StreamingQuery:
    """Load every Parquet file that has landed since the last run, then stop.

    A file is one dated snapshot of one sheet, text under flattened headers. The date is the
    one in its name, so files may arrive late or together; a file without one is a copy of the
    newest and is passed over. Loading is idempotent: a batch
    that is run again after a failure changes nothing. Progress is kept in `checkpoint`, or
    else in the shared folder the cluster names.

    The stream is of file names, at most `files` a batch; the columns are those of the batch's own files, so a file
    that brings a new one may land at any time. `headers` that no file has are empty.
    """
    if checkpoint is None:
        checkpoint = f"{spark.conf.get('spark.checkpoint.dir')}/ingest-{table.name}"
    options = {"pathGlobFilter": "*.parquet", "maxFilesPerTrigger": files}
    landed = spark.readStream.format("binaryFile").schema(FILE_COLUMNS).options(**options).load(landing)

    def load(batch: DataFrame, _: int) -> None:
        paths = [row.path for row in batch.collect()]  # the names of a batch's files
        if paths:
            rows = read_landed(batch.sparkSession, paths)
            missing = {h: F.lit(None).cast("string") for h in headers if h not in rows.columns}
            rows = rows.withColumns(missing) if missing else rows
            table.load_dated(incoming_rows(shape_snapshot(rows, file_date()).drop(FILE_NAME)))

    return (
        landed.select("path").writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
