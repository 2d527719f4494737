"""SimHash near-duplicates: fingerprints that differ in few bits, compared on vertical bit planes.

Null and empty texts have no words; their fingerprint is zero and is linked like any other. Copies share a
fingerprint and are compared once. Repeated rows get one result row each. An empty table gives an empty
result. Rows without doc_id get the component of their fingerprint, which is null if nobody in it has an id.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog.llm.common import add_columns, arrow_map, free_name, staged
from backlog.llm.components import components

#: Rows that a task compares at once, in whole buckets; pieces of hot buckets are far smaller.
CHUNK = 1 << 18
SHINGLES_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Settings:
    """Shingle length, greatest bit distance, and fingerprints of a bucket that are compared in one place.

    Fingerprints at most `distance` bits apart agree in one of distance + 1 parts; with `more_parts` further
    parts they agree in more of them at once, so buckets get smaller and tables more. Every choice finds all.
    """

    words: int = 3
    distance: int = 3
    bucket_rows: int = 1 << 14
    more_parts: int = 0


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits: 1 where more than half of the shingles' hashes have a 1."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= words:
        starts, ends = [0], [len(joined)]
    else:
        ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
        starts = [0, *ends[:-words].tolist()]
        ends = (ends[words - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(starts), SHINGLES_AT_ONCE):
        part = [digest(joined[a:b], 42) for a, b in zip(starts[k:k + SHINGLES_AT_ONCE], ends[k:k + SHINGLES_AT_ONCE])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield {"doc_id": batch.column(0), "fp": pa.array(values.view(np.int64))}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, fp long")


class Planes:
    """Fingerprints stored by bit: plane b holds bit b of all of them, 64 to a machine word."""

    def __init__(self, values: np.ndarray):
        self.n, self.words = len(values), (len(values) + 63) // 64
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        padded = np.zeros((64, (self.words + 1) * 64), np.uint8)
        padded[:, :self.n] = bits.T
        self.planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")

    def near(self, shift: int, lanes: np.ndarray, radius: int) -> np.ndarray:
        """Of the rows marked in `lanes`, those i whose row i + shift is at most `radius` bits away.

        One carry-save counter a lane, of as many bits as the radius needs and one that stays set on
        overflow. A word of 64 lanes is left once all of them exceed the radius.
        """
        blocks = np.flatnonzero(lanes)
        over = ~lanes[blocks]
        counters = [np.zeros(len(blocks), np.uint64) for _ in range(max(1, radius.bit_length()))]
        skip, bit = divmod(shift, 64)
        for plane in self.planes:
            other = _at(plane, blocks + skip)
            if bit:
                other = (other >> np.uint64(bit)) | (_at(plane, blocks + skip + 1) << np.uint64(64 - bit))
            carry = plane[blocks] ^ other
            for k, c in enumerate(counters):
                counters[k], carry = c ^ carry, c & carry
            over |= carry
            if radius + 1 < 1 << len(counters):
                over |= _exceeds(counters, radius)
            alive = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not alive.all():
                blocks, over = blocks[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(blocks):
                    break
        out = np.zeros(len(lanes), np.uint64)
        out[blocks] = ~over
        return unpacked(out)


def _at(plane: np.ndarray, places: np.ndarray) -> np.ndarray:
    return plane[np.minimum(places, len(plane) - 1)]


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius: the first bit from above that differs decides."""
    above, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            same &= counters[k]
        else:
            above |= same & counters[k]
            same &= ~counters[k]
    return above


def packed(marks: np.ndarray) -> np.ndarray:
    out = np.zeros((len(marks) + 63) // 64 * 64, np.uint8)
    out[:len(marks)] = marks
    return np.packbits(out, bitorder="little").view("<u8")


def unpacked(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def linked(values: np.ndarray, buckets: np.ndarray, radius: int) -> np.ndarray:
    """Rows (i, j) that connect all rows of the same bucket within the radius; buckets stand together.

    Only links that join what was apart so far are returned, at most a few a row.
    """
    n = len(values)
    planes = Planes(np.ascontiguousarray(values, "<u8"))
    label, out = np.arange(n), []
    # Row i has partners up to the end of its bucket.
    ends = np.flatnonzero(np.append(buckets[1:] != buckets[:-1], True)) + 1
    left = ends[np.searchsorted(ends, np.arange(n), side="right")] - np.arange(n) - 1
    for shift in range(1, int(left.max(initial=0)) + 1):
        rows = np.flatnonzero(left >= shift)
        rows = rows[label[rows] != label[rows + shift]]
        if not len(rows):
            continue
        marks = np.zeros(n, bool)
        marks[rows] = True
        i = planes.near(shift, packed(marks), radius)
        if not len(i):
            continue
        j = i + shift
        out.append(np.stack([i, j], 1))
        while len(i):  # every label sinks to the least of what it is linked to
            a, b = label[i], label[j]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _cuts(parts: int) -> list[tuple[int, int]]:
    """(first bit, bits) of `parts` parts that make up 64 bits."""
    edges = [64 * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(fps: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(a, b) of different fingerprints that connect all those within the distance.

    `fps` holds each fingerprint once, as fp. A bucket beyond `bucket_rows` is cut into pieces by hash, and
    every pair of pieces meets in a task of its own, so no task holds a whole hot bucket.
    """
    parts = settings.distance + 1 + settings.more_parts
    cuts = _cuts(parts)
    keys = []
    for number, chosen in enumerate(combinations(cuts, parts - settings.distance)):
        key = F.lit(number).cast("long")
        for first, bits in chosen:
            part = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
            key = F.xxhash64(key, part)
        keys.append(key)
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    pieces = (
        rows.groupBy("key").count().where(F.col("count") > settings.bucket_rows)
        .select(F.col("key").alias("hot"), F.ceil(F.col("count") * 2 / settings.bucket_rows).cast("int").alias("pieces"))
    )
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("n")).cast("int")
    rows = (
        rows.join(pieces, F.col("key") == F.col("hot"), "left")
        .select("fp", "key", F.coalesce("pieces", F.lit(1)).alias("n")).select("fp", "key", "n", own.alias("p"))
        .select("fp", "key", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("q"), "p")
        .select("fp", F.xxhash64("key", F.least("p", "q"), F.greatest("p", "q")).alias("place"))
    )
    radius = settings.distance

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        held_fp, held_place = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def compare(fp: np.ndarray, place: np.ndarray) -> dict:
            found = linked(fp.view(np.uint64), place, radius)
            return {"a": pa.array(fp[found[:, 0]]), "b": pa.array(fp[found[:, 1]])}

        for batch in batches:
            held_fp = np.concatenate([held_fp, batch.column(0).to_numpy()])
            held_place = np.concatenate([held_place, batch.column(1).to_numpy()])
            # The last bucket may go on in the next batch.
            if len(held_fp) >= CHUNK and (last := int(np.searchsorted(held_place, held_place[-1]))):
                yield compare(held_fp[:last], held_place[:last])
                held_fp, held_place = held_fp[last:], held_place[last:]
        if len(held_fp):
            yield compare(held_fp, held_place)

    dealt = rows.repartition("place").sortWithinPartitions("place")
    return arrow_map(dealt, run, "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, fingerprint, component_id, group_print) of every row.

    component_id: the smallest doc_id reachable over links of at most `distance` bits; group_print: the
    fingerprint that names the component, also where no row of it has an id.
    """
    prints = staged(fingerprints(docs, settings.words), "simhash")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = links(least.select("fp"), settings)
    roots = components(edges)
    # Components are numbered by fingerprint; now by the least document in them.
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    named = rooted.join(ids, F.col("root") == F.col("of")).select(F.col("fp").alias("same"), "component_id", "root")
    named = staged(named, "simhash-components")
    return prints.join(named, F.col("fp") == F.col("same")).select(
        "doc_id", _hex("fp").alias("fingerprint"), "component_id", _hex("root").alias("group_print")
    )


def _hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, with their columns, of which each has the least doc_id of its component.

    Where that is repeated, or no row of the component has an id, the least row of all its columns stays.
    """
    groups = staged(near_duplicates(docs, settings), "simhash-groups")
    rows_of = groups.groupBy(F.col("doc_id").alias("id")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("component")
    )
    key = free_name(docs, "kept_id")
    once = rows_of.where("rows = 1 and id = component").select(F.col("id").alias(key))
    kept = docs.join(once, F.col("doc_id").cast("long") == F.col(key)).select(*docs.columns)
    # Ids that several rows have, and rows without id, are told apart by fingerprint too.
    names = [f"c{k}" for k in range(len(docs.columns))]
    renamed = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)], F.col("doc_id").cast("long").alias("row_id"), "text")
    several = rows_of.where("rows > 1 and id is not null").select("id")
    unclear = renamed.join(several, F.col("row_id") == F.col("id"), "left_semi").unionByName(renamed.where("row_id is null"))
    marked = add_columns(
        unclear, ["text"], lambda texts: {"print": [f"{fingerprint(t, settings.words):016x}" for t in texts]}, {"print": T.StringType()}
    ).drop("text")
    heads = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("head_id"), F.col("fingerprint").alias("head_print"), "group_print"
    ).distinct()
    found = marked.join(heads, F.col("row_id").eqNullSafe(F.col("head_id")) & (F.col("print") == F.col("head_print")))
    least = found.groupBy("group_print").agg(F.min(F.struct(*names)).alias("row"))
    return kept.unionByName(least.select(*[F.col(f"row.{n}").alias(c) for n, c in zip(names, docs.columns)]))
