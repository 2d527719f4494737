"""WARC archives of pages, and their index merged into one order.

`write` makes records; `runs` reads the archives back, each of them one run of index lines sorted by URL key,
time and page_id; `merged` brings the runs into one global order, slice by slice, with a loser tree each.

A null html is an empty payload. A null url leaves the target header out and has an empty key. Rows without
page_id are written too, but nothing refers to them unless all equal payloads lack one. Repeated rows with the
least page_id of their payload are all responses. An empty table gives an empty index. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog.llm.common import arrow_map, new_folder, staged
from backlog.operators.joins import join_per_key

END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
FIELDS = [f.split()[0] for f in LINE.split(", ")]


@dataclass(frozen=True)
class Settings:
    """Payloads from `least_shared` bytes on are stored once. An archive has at most `records` records, and a
    task merges about `slice_rows` index lines. Captures are dated from `first_capture`, a second each page_id."""

    least_shared: int = 100
    records: int = 2_000
    slice_rows: int = 100_000
    first_capture: str = "2024-01-01T00:00:00Z"


def records(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(record): each page as the text of a WARC record, without the two line ends that close it."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    own = own.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    # Copies of a payload are counted before the shuffle; a row for each payload held twice or more.
    shared = (
        own.where(F.col("bytes") >= settings.least_shared).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    )
    joined = join_per_key(own, shared, ["digest"], "left")
    revisit = F.coalesce(F.col("first") != F.col("page_id"), F.col("first").isNotNull())
    when = F.date_format(
        F.timestamp_seconds(F.unix_timestamp(F.to_timestamp(F.lit(settings.first_capture))) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    # Line ends in a URL would end its header.
    url = F.regexp_replace("url", "[\\x00-\\x1f]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "bytes", F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload").cast("string")))

    def header(name: str, value) -> F.Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    optional = lambda name, value: F.coalesce(header(name, value), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        optional("WARC-Target-URI", url),
        header("WARC-Date", when),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        header("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(
            header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))),
            header("WARC-Profile", F.lit(REVISIT_PROFILE)),
        )).otherwise(""),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    )
    return joined.withColumn("block", block).select(record.alias("record"))


def write(pages: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """Gzipped archives below `path`; every record ends in two line ends, as the format asks."""
    (
        records(pages, settings).write.option("lineSep", END.decode()).option("compression", "gzip")
        .option("maxRecordsPerFile", settings.records).text(path)
    )


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an unpacked archive, found by its Content-Length."""
    at = 0
    while at < len(archive):
        end = archive.index(END, at)
        first, *lines = archive[at:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {name.lower(): value.strip() for name, value in (line.split(":", 1) for line in lines)}
        start = end + len(END)
        at = start + int(headers["content-length"])
        yield headers, archive[start:at]
        if archive[at:at + len(END)] != END:
            raise ValueError(f"a record does not end at byte {at}")
        at += len(END)


def unpacked(data: bytes) -> bytes:
    """All gzip members of an archive."""
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def url_key(url: str | None) -> str:
    """The host's labels from the right, the port, path and query; without scheme, user, www and fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.strip().lower()
    at = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    query = f"?{'&'.join(sorted(parts.query.split('&')))}" if parts.query else ""
    return f"{at}){parts.path or '/'}{query}".lower()


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def index_line(headers: dict[str, str], block: bytes) -> tuple:
    """The index line of a record, its digest checked against the payload where the record holds one."""
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    size = int(headers["warc-payload-length"])
    if headers["warc-type"] == "response":
        payload = block[block.index(END) + len(END):]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged payload in {headers['warc-record-id']}")
    return (
        url_key(headers.get("warc-target-uri")), headers["warc-date"], _page(headers["warc-record-id"]), size, digest,
        headers["warc-type"], _page(headers.get("warc-refers-to")),
    )


def order_of(line: tuple) -> tuple:
    """Lines are ordered by URL key, time and page_id, without a page_id first."""
    return line[0], line[1], line[2] is not None, line[2] or 0


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Index lines of the archives below `path`, with the archive (run) and the place in its sorted run (seq)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                lines = sorted((index_line(*r) for r in parsed(unpacked(content.as_py()))), key=order_of)
                if lines:
                    columns = dict(zip(FIELDS, map(list, zip(*lines))))
                    yield columns | {"run": [file.as_py()] * len(lines), "seq": list(range(len(lines)))}

    return arrow_map(files, run, f"{LINE}, run string, seq long")


class LoserTree:
    """Merges sorted runs. Inner nodes hold the loser of their match; the winner's path is played anew."""

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources, self.k = sources, max(1, len(sources))
        self.heads = [next(s, None) for s in sources] or [None]
        self.keys = [None if h is None else order_of(h) for h in self.heads]
        self.losers = [-1] * self.k
        self.winner = self._first(1)

    def _beats(self, a: int, b: int) -> bool:
        """An empty run loses; of equal lines, that of the earlier run wins."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def _first(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._first(2 * node), self._first(2 * node + 1)
        won, self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return won

    def __iter__(self) -> Iterator[tuple]:
        while self.keys[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            self.heads[w] = next(self.sources[w], None)
            self.keys[w] = None if self.heads[w] is None else order_of(self.heads[w])
            node = (w + self.k) // 2
            while node:
                if self._beats(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def merged(index: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The lines of all runs with `position`, their place in the global order from 0.

    Lines are dealt to slices by ranges of the whole order, so a URL captured very often spreads over many
    slices; a slice holds a stretch of each run, and a loser tree merges the stretches.
    """
    index = staged(index, "warc-runs")
    slices = max(1, -(-index.count() // settings.slice_rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        stretches: dict[str, list[tuple]] = {}
        for batch in batches:
            rows = zip(*[batch.column(name).to_pylist() for name in ("run", *FIELDS)])
            for name, *line in rows:
                stretches.setdefault(name, []).append(tuple(line))
        lines = list(LoserTree([iter(s) for _, s in sorted(stretches.items())]))
        if lines:
            own = TaskContext.get().partitionId()
            yield dict(zip(FIELDS, map(list, zip(*lines)))) | {"slice": [own] * len(lines), "at": list(range(len(lines)))}

    dealt = index.repartitionByRange(slices, "url_key", "captured", F.col("page_id").asc_nulls_first(), "run", "seq")
    ordered = staged(arrow_map(dealt.sortWithinPartitions("run", "seq"), run, f"{LINE}, slice int, at long"), "warc-index")
    before, sizes = 0, ordered.groupBy("slice").count().orderBy("slice").collect()  # a row for each slice
    starts = []
    for row in sizes:
        starts.append((row["slice"], before))
        before += row["count"]
    offsets = ordered.sparkSession.createDataFrame(starts, "of int, before long")
    return ordered.join(F.broadcast(offsets), F.col("slice") == F.col("of")).withColumn("position", F.col("before") + F.col("at")).select(*FIELDS, "position")


def archived(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Write the pages into archives in the shared folder, read them back, and merge their index."""
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write(pages, path, settings)
    return merged(runs(spark, path), settings)
