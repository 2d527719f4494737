"""CSV sheets as a Python data source that reads one file in many tasks.

A file is cut into ranges of bytes. Whether a line end stands inside a quoted cell depends on all quotes before
it, so files of several ranges are read twice: first every range tells in which state it leaves the reader for
each state that it may begin in (`leaves`), then the states are followed through the file and every task reads
the records that begin in its range. A file of one range is read once.

Cells are parted as Python's `csv` does it: commas, doubled quotes, any line ends; a quote inside an unquoted cell
is an ordinary character.
"""

from __future__ import annotations

import csv
import json
import re
import sys
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The source travels to the executors by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOM = b"\xef\xbb\xbf"
LINE_END = re.compile(rb"\r\n|\n|\r")
#: Outside quotes, inside them, inside them with the first half of a doubled quote just read.
OUTSIDE, INSIDE, HALF = "oih"
RANGE_BYTES = 32 << 20
#: Ranges of all files of a sheet together; where there would be more, ranges are longer, up to RANGE_BYTES.
MOST_RANGES = 500
HEAD_BYTES = 1 << 16
#: Records that a task sends on together.
ROWS = 5_000
#: Stores that a task can open by itself, by Hadoop's name for them.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def can_open(path: str) -> bool:
    return urlsplit(path).scheme in SCHEMES


def opened(path: str) -> pa.NativeFile:
    """A file, by the path that Spark gives it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, inside = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{quote(rest)}")
    return store.open_input_file(inside)


class Lines:
    """The lines of a file from a byte on, with their ends; `at` is where the next one begins."""

    def __init__(self, file: pa.NativeFile, at: int, chunk: int = 1 << 20):
        self._file, self.at, self._chunk = file, at, chunk
        self._held, self._place, self._over = b"", 0, False
        file.seek(at)

    def __iter__(self) -> Iterator[str]:
        return self

    def __next__(self) -> str:
        look = self._place
        while True:
            found = LINE_END.search(self._held, look)
            # A carriage return at the very end may be half a line end.
            if found and (found.end() < len(self._held) or self._over or found.group() != b"\r"):
                end = found.end()
                break
            if self._over:
                end = len(self._held)
                break
            look = max(0, (found.start() if found else len(self._held)) - self._place)
            more = self._file.read(self._chunk)
            self._over = not more
            self._held, self._place = self._held[self._place:] + more, 0
        if end == self._place:
            raise StopIteration
        line = self._held[self._place:end]
        self.at += len(line)
        self._place = end
        return line.decode("utf-8")


def records(file: pa.NativeFile, start: int, stop: int | None = None) -> Iterator[tuple[list[str], int]]:
    """(cells, end) of the records that begin from byte `start` on, before byte `stop`. Empty lines are none."""
    csv.field_size_limit(1 << 30)
    # Of a short range no more is read ahead than its own length.
    lines = Lines(file, start, 1 << 20 if stop is None else min(1 << 20, max(1 << 12, stop - start)))
    reader = csv.reader(lines)
    while stop is None or lines.at < stop:
        cells = next(reader, None)
        if cells is None:
            return
        if cells:
            yield cells, lines.at


def head(file: pa.NativeFile, title_rows: int, header_rows: int) -> tuple[list[list[str]], int]:
    """The header records of a sheet, and the byte where its first row begins. Only the first bytes are read."""
    file.seek(0)
    start = len(BOM) if file.read(len(BOM)) == BOM else 0
    out, body, wanted = [], start, title_rows + header_rows
    reader = records(file, start)
    while len(out) < wanted and (found := next(reader, None)):
        out.append(found[0])
        body = found[1]
    return out[title_rows:], body


def _quotes(data: bytes, state: str, before: int | None, after: int | None) -> Iterator[tuple[int, int, str]]:
    """(begin, end, state) of the stretches of a range that lie outside or inside quotes; the last has its end state.

    `before` and `after`: the bytes around the range; None where the rows begin and the file ends.
    """
    begin, skip = 0, -1
    at = data.find(b'"')
    if state == HALF:  # the range begins with the second half of a doubled quote
        state, skip = INSIDE, 0
    while at >= 0:
        if at == skip:
            pass
        elif state == OUTSIDE:
            previous = data[at - 1] if at else before
            if previous is None or previous in b",\r\n":
                yield begin, at, OUTSIDE
                begin, state = at, INSIDE
        else:
            following = data[at + 1] if at + 1 < len(data) else after
            if following == 0x22:
                skip = at + 1
                if skip == len(data):
                    yield begin, len(data), INSIDE
                    yield len(data), len(data), HALF
                    return
            else:
                yield begin, at + 1, INSIDE
                begin, state = at + 1, OUTSIDE
        at = data.find(b'"', at + 1)
    yield begin, len(data), state


def leaves(data: bytes, before: int | None, after: int | None) -> dict[str, str]:
    """The state at the end of a range, for each state at its beginning."""
    out = {}
    for state in (OUTSIDE, INSIDE, HALF):
        for _, _, last in _quotes(data, state, before, after):
            out[state] = last
    return out


def first_record(data: bytes, state: str, before: int | None, after: int | None) -> int | None:
    """Where in a range the first record begins; None if none does."""
    if state == OUTSIDE and (before is None or before == 0x0A or before == 0x0D and data[:1] != b"\n"):
        return 0
    for begin, end, where in _quotes(data, state, before, after):
        if where != OUTSIDE:
            continue
        for found in LINE_END.finditer(data, begin, end):
            if found.end() == len(data) and found.group() == b"\r" and after == 0x0A:
                continue  # the line end goes on in the next range
            return found.end() if found.end() < len(data) else None
    return None


def _around(file: pa.NativeFile, body: int, start: int, stop: int, size: int) -> tuple[bytes, int | None, int | None]:
    """A range's bytes and those around it."""
    file.seek(max(start - 1, body))
    data = file.read(stop + 1 - max(start - 1, body))
    before = data[0] if start > body else None
    own = data[start > body:][:stop - start]
    return own, before, data[-1] if stop < size else None


class SheetRange(InputPartition):
    def __init__(self, path: str, size: int, body: int, start: int, stop: int, state: str | None, layout: int | None):
        super().__init__(start)
        self.path, self.size, self.body, self.start, self.stop, self.state, self.layout = path, size, body, start, stop, state, layout


class SheetReader(DataSourceReader):
    """Reads the ranges of the option `files`: a JSON list of (path, size, body, states, layout).

    Without states the ranges' `leaves` are told, as (path, start, [from outside, inside, half]); with them the
    records, as (path, start, cells). Every cell is moved to the place that its layout gives its position, from
    the option `layouts`; cells beyond the layout are dropped.
    """

    def __init__(self, options: dict[str, str]):
        self._files = json.loads(options["files"])
        self._layouts = json.loads(options["layouts"])
        self._bytes = int(options["rangeBytes"])

    def partitions(self) -> list[SheetRange]:
        out = []
        for path, size, body, letters, layout in self._files:
            for k, start in enumerate(range(body, size, self._bytes)):
                state = letters[k] if letters else None
                out.append(SheetRange(path, size, body, start, min(size, start + self._bytes), state, layout))
        return out

    def read(self, partition: SheetRange | None) -> Iterator[pa.RecordBatch]:
        p = partition
        if p is None:  # no file has any rows
            return
        with opened(p.path) as file:
            begin = 0
            if p.state is None or p.start > p.body:
                own, before, after = _around(file, p.body, p.start, p.stop, p.size)
                if p.state is None:
                    found = leaves(own, before, after)
                    yield self._batch(p, [[found[s] for s in (OUTSIDE, INSIDE, HALF)]])
                    return
                begin = first_record(own, p.state, before, after)
                del own
            if begin is None:
                return
            rows, places = [], self._layouts[p.layout]
            for cells, _ in records(file, p.start + begin, p.stop):
                if not any(cells):
                    continue
                row: list[str | None] = [None] * (max(places, default=-1) + 1)
                for place, cell in zip(places, cells):
                    if cell != "":
                        row[place] = cell
                rows.append(row)
                if len(rows) == ROWS:
                    yield self._batch(p, rows)
                    rows = []
            if rows:
                yield self._batch(p, rows)

    @staticmethod
    def _batch(p: SheetRange, rows: list[list[str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([p.path] * len(rows), pa.string()), pa.array([p.start] * len(rows), pa.int64()), pa.array(rows, pa.list_(pa.string()))],
            names=["path", "start", "cells"],
        )


class SheetSource(DataSource):
    """`spark.read.format("csv_ranges")`, registered by `ranges`."""

    @classmethod
    def name(cls) -> str:
        return "csv_ranges"

    def schema(self) -> str:
        return "path string, start long, cells array<string>"

    def reader(self, schema) -> SheetReader:
        return SheetReader(self.options)


def ranges(spark: SparkSession, files: Iterable[tuple], layouts: list[list[int]], range_bytes: int) -> DataFrame:
    """The source over files (path, size, body, states, layout), the last two None to be told the states."""
    spark.dataSource.register(SheetSource)
    options = {"files": json.dumps(list(files)), "layouts": json.dumps(layouts), "rangeBytes": str(range_bytes)}
    return spark.read.format("csv_ranges").options(**options).load()


def heads(files: DataFrame, title_rows: int, header_rows: int) -> DataFrame:
    """(path, size, body, header) of files (path, length): what stands above the rows of each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, size in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(path) as file:
                    header, body = head(file, title_rows, header_rows)
                rows.append((path, size, body, header))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(map(list, zip(*rows)), (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.string()))))],
                    names=["path", "size", "body", "header"],
                )

    return files.select("path", "length").mapInArrow(run, "path string, size long, body long, header array<array<string>>")


def range_length(sizes: Iterable[int], asked: int) -> int:
    """Bytes of a range: those asked for, or more where files of these sizes would make up too many ranges."""
    return max(asked, min(RANGE_BYTES, -(-sum(sizes) // MOST_RANGES)))


def states(spark: SparkSession, files: list[tuple[str, int, int]], range_bytes: int) -> dict[str, str]:
    """The state that each range of each file begins in, a letter a range."""
    long = [(path, size, body, None, None) for path, size, body in files if size - body > range_bytes]
    out = {path: OUTSIDE for path, size, body in files if size > body}
    if long:
        told = ranges(spark, long, [], range_bytes)
        found = told.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", F.concat_ws("", "cells").alias("ends")))).alias("ranges"))
        for row in found.select("path", "ranges.ends").collect():  # three letters a range
            state, letters = OUTSIDE, ""
            for ends in row["ends"]:
                letters += state
                state = ends[(OUTSIDE, INSIDE, HALF).index(state)]
            out[row["path"]] = letters
    return out
