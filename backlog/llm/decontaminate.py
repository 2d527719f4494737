"""Benchmark decontamination by greedy string tiling.

A document and a test item are compared if they share seeds, runs of `shortest` tokens. Tiles, the longest
common runs that don't overlap, are marked again and again, found by running Karp-Rabin; an item whose tokens
are tiled to at least `coverage` is in the document, also if its passages come in another order.

Null and empty texts hold nothing. Items of fewer than `min_item_tokens` tokens must be there whole, in one run, as a
part of one may be an ordinary phrase; items shorter than a seed are not judged. Texts are tiled whole, however long.
Tiles of one length: the first in the item, then in the document. Repeated items count once, repeated documents each.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog.llm.common import add_columns, arrow_map, free_name

TOKEN = re.compile(r"\w+")
MODULUS, BASE = (1 << 61) - 1, 1_000_003
PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Shortest tile, share of an item that has to be tiled, tokens of an item from which on that share is enough,
    tokens sent to tasks at once."""

    shortest: int = 4
    coverage: float = 0.6
    min_item_tokens: int = 8
    first_length: int = 20
    block_tokens: int = 1_000_000


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def _hashes(values: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(place, Karp-Rabin hash) of each run of `length` tokens that are all free, rolled on from the one before."""
    top = pow(BASE, length - 1, MODULUS)
    run = h = 0
    for i, value in enumerate(values):
        if not free[i]:
            run = h = 0
            continue
        if run == length:
            h = (h - values[i - length] * top) % MODULUS
        else:
            run += 1
        h = (h * BASE + value) % MODULUS
        if run == length:
            yield i - length + 1, h


def tiles(pattern: list[int], text: list[int], shortest: int, first_length: int = 20) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in pattern, place in text, length), longest first, without overlaps.

    Tokens 0 match nothing.
    """
    free_p, free_t = [v != 0 for v in pattern], [v != 0 for v in text]
    found: list[tuple[int, int, int]] = []
    length = max(shortest, min(first_length, len(pattern)))
    while True:
        places = defaultdict(list)
        for t, h in _hashes(text, free_t, length):
            places[h].append(t)
        matches, longest = [], 0
        for p, h in list(_hashes(pattern, free_p, length)) if places else ():
            for t in places.get(h, ()):
                k = 0
                while (
                    p + k < len(pattern) and t + k < len(text) and pattern[p + k] == text[t + k]
                    and free_p[p + k] and free_t[t + k]
                ):
                    k += 1
                if k >= length:  # else two runs have the same hash
                    matches.append((k, p, t))
                    longest = max(longest, k)
        if longest > 2 * length:
            length = longest
            continue
        for k, p, t in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if all(free_p[p:p + k]) and all(free_t[t:t + k]):
                free_p[p:p + k] = free_t[t:t + k] = [False] * k
                found.append((p, t, k))
        if any(k >= length for k in _left(matches, free_p, free_t)):
            continue  # what a longer tile has cut may still hold a run of this length
        if length == shortest:
            return found
        length = max(shortest, length // 2)


def _left(matches: list[tuple[int, int, int]], free_p: list[bool], free_t: list[bool]) -> Iterator[int]:
    """Longest run still free on both sides in each match."""
    for k, p, t in matches:
        best = run = 0
        for i in range(k):
            run = run + 1 if free_p[p + i] and free_t[t + i] else 0
            best = max(best, run)
        yield best


class Block:
    """Some test items, with their seeds in order of hash."""

    def __init__(self, items: list[tuple[int | None, list[str]]], settings: Settings):
        self.settings = settings
        words = sorted({w for _, tokens in items for w in tokens})
        self.numbers = {w: k + 1 for k, w in enumerate(words)}
        self.ids = [i for i, _ in items]
        self.items = [np.array([self.numbers[w] for w in tokens], np.int64) for _, tokens in items]
        hashes, owners, places = [], [], []
        for k, values in enumerate(self.items):
            h = self.seeds(values)
            hashes.append(h)
            owners.append(np.full(len(h), k))
            places.append(np.arange(len(h)))
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, owners, places)]
        order = np.argsort(joined[0], kind="stable")
        self.hashes, self.owners, self.places = (x[order] for x in joined)

    def seeds(self, values: np.ndarray) -> np.ndarray:
        """A hash of each run of `shortest` tokens."""
        k = self.settings.shortest
        h = np.zeros(max(0, len(values) - k + 1), np.uint64)
        for i in range(k):
            h = (h ^ values[i:i + len(h)].astype(np.uint64)) * PRIME
            h ^= h >> np.uint64(29)
        return h

    def matches(self, text: str | None) -> list[tuple[int | None, float, list[tuple[int, int, int]]]]:
        """(item_id, coverage, tiles) of each item that the text holds; tiles are in tokens: item, text, length."""
        words = tokens_of(text)
        get = self.numbers.get
        values = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        if not len(self.hashes) or len(values) < self.settings.shortest:
            return []
        h = self.seeds(values)
        first = np.searchsorted(self.hashes, h, side="left")
        hit = np.flatnonzero(self.hashes[np.minimum(first, len(self.hashes) - 1)] == h)
        if not len(hit):
            return []
        upto = np.searchsorted(self.hashes, h[hit], side="right")
        by_item: dict[int, tuple[list, set]] = {}
        for t, a, b in zip(hit.tolist(), first[hit].tolist(), upto.tolist()):
            for k in range(a, b):
                spots = by_item.setdefault(int(self.owners[k]), ([], set()))
                spots[0].append(t)
                spots[1].add(int(self.places[k]))
        out = []
        for k, (in_text, in_item) in sorted(by_item.items()):
            item = self.items[k]
            need = len(item) * (self.settings.coverage if len(item) >= self.settings.min_item_tokens else 1)
            if _reach(in_item, self.settings.shortest) < need:
                continue  # tiles lie in seeds, so the item can't be covered
            at = np.unique((np.unique(in_text)[:, None] + np.arange(self.settings.shortest)).ravel())
            # Only the tokens in seeds of this item; a 0 stands where others are left out.
            cut = np.flatnonzero(np.diff(at) > 1) + 1
            spots = np.insert(at, cut, -1)
            kept = np.where(spots < 0, 0, values[spots])
            found = tiles(item.tolist(), kept.tolist(), self.settings.shortest, self.settings.first_length)
            covered = sum(length for _, _, length in found)
            if covered >= need:
                out.append((self.ids[k], covered / len(item), [(p, int(spots[t]), n) for p, t, n in found]))
        return out


def _reach(places: set[int], length: int) -> int:
    """Tokens that lie in runs of `length` beginning at the places."""
    return len({p + i for p in places for i in range(length)})


def blocks(benchmark: DataFrame, settings: Settings = Settings()) -> Iterator[Block]:
    """The benchmark in blocks of about `block_tokens` tokens, each of which is sent to all tasks in turn."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").dropDuplicates()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // (4 * settings.block_tokens)))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = sorted((r.item_id is None, r.item_id or 0, r.text) for r in part.collect())
        yield Block([(None if none else i, tokens_of(text)) for none, i, text in rows], settings)


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, coverage, tiled_tokens, tiles) for each test item that a document holds.

    tiles: structs of the first token in the item, the first token in the document, and the length.
    """
    schema = "doc_id long, item_id long, coverage double, tiled_tokens long, tiles array<struct<item_at:long,doc_at:long,tokens:long>>"
    out = None
    for block in blocks(benchmark, settings):

        def run(batches: Iterable[pa.RecordBatch], block=block) -> Iterator[dict]:
            for batch in batches:
                rows = [
                    (doc_id, item, share, sum(t[2] for t in found), [dict(item_at=p, doc_at=t, tokens=n) for p, t, n in found])
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for item, share, found in block.matches(text)
                ]
                if rows:
                    yield dict(zip(("doc_id", "item_id", "coverage", "tiled_tokens", "tiles"), map(list, zip(*rows))))

        part = arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no test item, with their columns as they are."""
    columns = docs.columns
    for block in blocks(benchmark, settings):
        flag = free_name(docs, "holds_item")
        mark = lambda texts, block=block, flag=flag: {flag: [bool(block.matches(t)) for t in texts]}
        docs = add_columns(docs, ["text"], mark, {flag: T.BooleanType()}).where(~F.col(flag)).select(*columns)
    return docs
