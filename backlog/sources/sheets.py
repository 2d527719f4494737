"""Landed sheets: workbook sheets exported as CSV, or as Parquet for large histories.

All cells are read as text; `operators.shape` gives them their types.
"""

from __future__ import annotations

import csv
import io
import os
import sys
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import accumulate, islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog.functions.dates import snapshot_date_of
from backlog.operators.shape import flatten_columns, name_header_levels
from backlog.sources import csv_ranges

# A snapshot sheet has two title rows above its two header rows.
TITLE_ROWS, HEADER_ROWS = 2, 2

FILE_NAME = "_file_name"
_RECORDS = "path string, record long, cells array<string>"

# The record reader travels to the executors by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _parsed(batches: Iterable[pa.RecordBatch], skip: int, take: int | None) -> Iterator[pa.RecordBatch]:
    """Records `skip` to `skip + take` of each file (path, content), numbered, as text cells; empty cells are null.

    Lines without any cell are no records. A quoted cell may hold line ends, so a file is read by one task.
    """
    csv.field_size_limit(1 << 30)
    target = pa.schema([("path", pa.string()), ("record", pa.int64()), ("cells", pa.list_(pa.string()))])
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            lines = io.TextIOWrapper(io.BytesIO(content.as_py()), encoding="utf-8-sig", newline="")
            records = enumerate(r for r in csv.reader(lines) if r)
            wanted = islice(records, skip, None if take is None else skip + take)
            while part := list(islice(wanted, 5_000)):
                cells = [[c if c != "" else None for c in cells] for _, cells in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(part)), pa.array([n for n, _ in part], pa.int64()), pa.array(cells, pa.list_(pa.string()))],
                    schema=target,
                )


def _records(spark: SparkSession, paths: str | list[str], skip: int = 0, take: int | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(lambda batches: _parsed(batches, skip, take), _RECORDS)


def read_snapshot(
    spark: SparkSession,
    path: str | list[str],
    title_rows: int = TITLE_ROWS,
    header_rows: int = HEADER_ROWS,
    range_bytes: int = csv_ranges.RANGE_BYTES,
) -> DataFrame:
    """One or many dated CSV exports of one sheet, under flattened headers, with `_file_name`.

    Every file is read under its own header, however wide, and stacked by column name: those of the first file,
    then what others have besides. Title and header records are told by their place in the file. The header
    comes from a file's first bytes; its rows from ranges of `range_bytes`, each in a task of its own, or of more
    where that would be very many tasks.
    Files in a store that only Spark can open are read whole, each by one task.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # a listing; nothing is read
    if not files.where(~F.substring_index("path", ":", 1).isin(*csv_ranges.SCHEMES)).isEmpty():
        return _whole_files(spark, path, title_rows, header_rows)
    told = csv_ranges.heads(files, title_rows, header_rows).groupBy("header").agg(F.array_sort(F.collect_list(F.struct("path", "size", "body"))).alias("files"))
    layouts = sorted(((row["files"], _names(row["header"])) for row in told.collect()), key=lambda x: x[0][0]["path"])  # one row a layout
    layouts = [(held, names) for held, names in layouts if names]
    if not layouts:
        raise ValueError(f"no sheet with a header in {path}")
    columns: dict[tuple[str, int], int] = {}  # a name that a header has twice has two columns
    placed, plan = [], []
    for number, (held, names) in enumerate(layouts):
        keys = [(name, names[:i].count(name)) for i, name in enumerate(names)]
        placed.append([columns.setdefault(key, len(columns)) for key in keys])
        plan += [(f["path"], f["size"], f["body"], number) for f in held]
    range_bytes = csv_ranges.range_length([size - body for _, size, body, _ in plan], range_bytes)
    letters = csv_ranges.states(spark, [entry[:3] for entry in plan], range_bytes)
    todo = [(file, size, body, letters[file], number) for file, size, body, number in plan if size > body]
    rows = csv_ranges.ranges(spark, todo, placed, range_bytes)
    cells = [F.get("cells", F.lit(place)).alias(name) for (name, _), place in columns.items()]
    first = len(layouts[0][1])
    return rows.select(*cells[:first], F.regexp_extract("path", "[^/]+$", 0).alias(FILE_NAME), *cells[first:])


def _names(header: list[list[str | None]]) -> list[str]:
    """The flattened column names of a header, as wide as its last filled cell."""
    width = max((i + 1 for row in header for i, cell in enumerate(row) if cell), default=0)
    return flatten_columns(name_header_levels([(list(row) + [None] * width)[:width] for row in header])) if width else []


def _whole_files(spark: SparkSession, path: str | list[str], title_rows: int, header_rows: int) -> DataFrame:
    layouts: dict[tuple[str, ...], list[str]] = {}
    heads: dict[str, list[list[str | None]]] = {}
    for row in _records(spark, path, title_rows, header_rows).orderBy("path", "record").collect():
        heads.setdefault(row.path, []).append(list(row.cells))
    for file, header in heads.items():
        if names := _names(header):
            layouts.setdefault(tuple(names), []).append(file)
    if not layouts:
        raise ValueError(f"no sheet with a header in {path}")
    frames = [_under(spark, list(names), files, title_rows + header_rows) for names, files in layouts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _under(spark: SparkSession, names: list[str], files: list[str], skip: int) -> DataFrame:
    """The records of files of one layout; those without any filled cell are none."""
    rows = _records(spark, files, skip).where(F.exists("cells", lambda c: c.isNotNull()))
    cells = [F.try_element_at("cells", F.lit(i + 1)).alias(name) for i, name in enumerate(names)]
    return rows.select(*cells, F.regexp_extract("path", "[^/]+$", 0).alias(FILE_NAME))


def landing_folder(spark: SparkSession, name: str) -> str:
    """A path no other run uses, in the shared folder the cluster names; a local one only where all runs in one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and not f"{spark.sparkContext.master}[".startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='landing-')}/landing/{name}-{uuid.uuid4().hex}"


def _csv_options() -> dict[str, str]:
    """Cells as they are: blanks kept, quotes doubled."""
    return {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _head(levels: list[tuple[str, ...]], titles: tuple[str, ...]) -> str:
    """The title rows and the header rows, without the last line end."""
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([[title, "as exported"] for title in titles] + [list(row) for row in zip(*levels)])
    return text.getvalue().removesuffix("\n")


def _lines(df: DataFrame) -> DataFrame:
    cells = F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)])
    return df.select(F.to_csv(cells, _csv_options()).alias("value"))


def write_snapshot(
    df: DataFrame, levels: list[tuple[str, ...]], path: str, titles: tuple[str, ...] = ("", "")
) -> None:
    """Land text cells as `read_snapshot` reads them; every file has the title rows and the header rows."""
    head = _head(levels, titles)

    def under_head(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [head]}, schema=pa.schema([("value", pa.string())]))
        yield from batches

    _lines(df).mapInArrow(under_head, "value string").write.text(path)


def write_one_file(
    df: DataFrame, levels: list[tuple[str, ...]], path: str, titles: tuple[str, ...] = ("", "")
) -> None:
    """Land text cells as `write_snapshot` does, as one file in the folder `path`.

    The rows are written as parts, in `path` with `-parts` behind it; then every part is copied to its place in the
    file by a task of its own. In stores whose files take no writes in place, one task writes the rows.
    """
    _lines(df).write.text(f"{path}-parts")
    spark = df.sparkSession
    held = spark.read.format("binaryFile").load(f"{path}-parts").select("path", "length")
    parts = [(row.path, row.length) for row in held.where("length > 0").orderBy("path").collect()]  # one row a part
    if any(not part.startswith("file:") for part, _ in parts):
        return write_snapshot(df.repartition(1), levels, path, titles)
    head = (_head(levels, titles) + "\n").encode()
    places = accumulate((length for _, length in parts), initial=len(head))
    folder = urlsplit(path).path if path.startswith("file:") else path
    target = f"{folder}/{uuid.uuid4().hex}.csv"

    def copy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at in zip(*(c.to_pylist() for c in batch.columns)):
                os.makedirs(folder, exist_ok=True)
                place = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
                with open(place, "wb") as out:
                    out.seek(at)
                    if part is None:
                        out.write(head)
                    else:
                        with csv_ranges.opened(part) as own:
                            while data := own.read(1 << 22):
                                out.write(data)
            yield batch

    todo = [(None, 0), *((part, at) for (part, _), at in zip(parts, places))]
    rows = spark.createDataFrame(todo, "part string, at long")
    rows.repartitionByRange(len(todo), "at").mapInArrow(copy, rows.schema).foreach(lambda row: None)


def write_cluster_sheet(df: DataFrame, path: str) -> None:
    """Land a sheet of the cluster workbook as `read_cluster` reads it."""
    df.write.options(header=True, **_csv_options()).csv(path)


def read_cluster(spark: SparkSession, sheets: dict[str, str | list[str]]) -> dict[str, DataFrame]:
    """The CSV exports of a cluster workbook by sheet name; one header row, no titles.

    Every file is read under its own header, as `read_snapshot` does it.
    """
    return {name: read_snapshot(spark, path, title_rows=0, header_rows=1) for name, path in sheets.items()}


def read_landed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S1 for Parquet: dated files whose columns already have flattened headers, all text."""
    df = spark.read.option("mergeSchema", "true").parquet(*([path] if isinstance(path, str) else path))
    text = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    return df.select(*text, F.col("_metadata.file_name").alias(FILE_NAME))


def file_date() -> Column:
    """The snapshot date in the name of the file a row was read from."""
    return snapshot_date_of(F.col(FILE_NAME))


def newest_file_rows(df: DataFrame) -> DataFrame:
    """The rows of the newest dated file."""
    newest = df.select(F.max(file_date())).scalar()
    return df.where(file_date() == newest)

