"""Best-fit packing of token pieces into sequences, after Martello and Toth's dominance reduction.

Pieces of equal length are interchangeable, so the plan is made on the number of pieces of each length, at
most `capacity` numbers, and pieces then take the places planned for their length. Null and empty texts are
one piece, the separator alone. Repeated rows are packed one by one; rows without doc_id too. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from backlog.llm.common import arrow_map, per_worker, staged

CAPACITY = 2048
#: ASCII characters that the tokenizer keeps apart from letters.
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
SEPARATOR = (0).to_bytes(4, "little")
#: Bytes of text whose words are looked up together.
LOT = 8 << 20
#: Words that a worker keeps the ids of, some 400 bytes each. The worker and they stay on while it runs other tasks.
MOST_WORDS = 900_000
#: Pieces of a length that one task numbers, about.
RANKED_TOGETHER = 20_000


class WordIds:
    """Little-endian ids of each word, worked out once.

    The tokenizer drops white space and never joins what stands on its two sides, so a text's ids are those
    of its words in a row. To it, letters are one unit, and so is the ASCII punctuation before or after them.
    """

    def __init__(self, path: str, most: int = MOST_WORDS):
        self.ids: dict[str, bytes] = {}
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True

    def encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def parts(self, w: str) -> tuple[str, ...]:
        """The units of a word, ASCII ones in lower case; none if it has others."""
        if w.isascii() and w.isalpha():
            return (w.lower(),)
        core = w.strip(PUNCTUATION)
        lead = w[:w.index(core)] if core else w
        if not (core.isalpha() and core.lower().isalpha()) or "'" in lead or "<|" in w:
            return ()
        return tuple(x for x in (lead, core.lower() if core.isascii() else core, w[len(lead) + len(core):]) if x)

    def learn(self, words: list[str]) -> None:
        """Ids of words, from those of their units, which are learned once and many in a call: each ends in a token
        that ends a word, so units can be counted."""
        made = [(w, self.parts(w)) for w in words]
        units = list({x for _, parts in made for x in parts}.difference(self.ids))
        for k in range(0, len(units), 500):
            part = units[k:k + 500]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 1
            if len(last) != len(part):
                self.ids.update((x, self.encoded(x)) for x in part)
                continue
            data, at = ids.tobytes(), 0
            for x, end in zip(part, (4 * last).tolist()):
                self.ids[x], at = data[at:end], end
        for w, parts in made:
            self.ids[w] = b"".join([self.ids[x] for x in parts]) if parts else self.encoded(w)

    def of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text's followed by the separator, and where each text's end."""
        spaced = pc.fill_null(texts.cast(pa.large_string()), "")
        for blank in "\n\t":
            spaced = pc.replace_substring(spaced, blank, " ")
        split = pc.split_pattern(spaced, " ")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if missing := [w for w in distinct if w not in self.ids]:
            if len(self.ids) > self.most:
                kept = {w: self.ids[w] for w in distinct if w in self.ids}  # what texts go on using
                self.ids.clear()
                self.ids.update(kept)
            self.learn(missing)
        own = [*map(self.ids.__getitem__, distinct), SEPARATOR]
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts = np.cumsum(sizes) - sizes
        upto = np.cumsum(pc.list_value_length(split).to_numpy())
        codes = np.insert(coded.indices.to_numpy(), upto, len(distinct))
        size = sizes[codes]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        small = np.int32 if max(total, int(sizes.sum())) < 1 << 31 else np.int64
        at = np.repeat((starts[codes] - ends + size).astype(small), size)
        at += np.arange(total, dtype=small)
        return np.frombuffer(b"".join(own), "<u4")[at], ends[upto + np.arange(len(upto))]

    def of(self, text: str | None) -> bytes:
        return self.of_all(pa.array([text], pa.string()))[0].tobytes()


def lots(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches (first, behind the last) of texts of about LOT bytes together."""
    lot = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // LOT
    cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), len(texts)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document, cut only where it is too long."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        words = per_worker(f"word ids {path}", lambda: WordIds(path))
        for first, last, batch in ((a, b, batch) for batch in batches for a, b in lots(batch.column(1))):
            rows, begin = [], 0
            every, ends = words.of_all(batch.column(1)[first:last])
            data = memoryview(every).cast("B")
            for doc_id, end in zip(batch.column(0)[first:last].to_pylist(), (4 * ends).tolist()):
                ids, begin = data[begin:end], end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(own) // 4, zlib.crc32(own), own))
            if rows:
                out = dict(zip([*names[:5], "ids"], map(list, zip(*rows))))
                out["ids"] = [np.frombuffer(x, "<u4").astype(np.int32) for x in out["ids"]] if with_ids else None
                yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


class Sizes:
    """How many items of each size are left, and which sizes there are, in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = Counter({s: n for s, n in counts.items() if n > 0})
        self.order = sorted(self.left)

    def take(self, items: Iterable[int], times: int) -> None:
        for s in items:
            self.left[s] -= times
            if not self.left[s]:
                del self.left[s]
                del self.order[bisect_left(self.order, s)]

    def largest(self, limit: int, without: Counter) -> int | None:
        """The largest size up to the limit, some items being spoken for."""
        k = bisect_right(self.order, limit) - 1
        while k >= 0 and self.left[self.order[k]] <= without[self.order[k]]:
            k -= 1
        return self.order[k] if k >= 0 else None

    def smallest(self, n: int, without: Counter) -> list[int]:
        out: list[int] = []
        for s in self.order:
            out += [s] * min(n - len(out), self.left[s] - without[s])
            if len(out) == n:
                break
        return out


def dominating(sizes: Sizes, w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with an item of size w that dominates every other such set: whatever else fits can be exchanged
    for its items, each of them taking in what it replaces. None if no set of up to three is seen to do so."""
    own = Counter([w])
    room = capacity - w
    k = sizes.largest(room, own)
    if k is None:
        return (w,)
    few = sizes.smallest(3, own)
    if k == room or len(few) < 2 or few[0] + few[1] > room:
        return w, k  # no second item fits beside w, or none is needed
    if len(few) == 3 and sum(few) <= room:
        return None
    # At most two items fit beside w. Each such pair x >= y must fit into k alone, or x into k and y into s.
    s = sizes.largest(room - k, own + Counter([k]))
    for x in sizes.order[:bisect_right(sizes.order, k)]:
        if sizes.left[x] <= own[x]:
            continue
        y = sizes.largest(min(x, room - x), own + Counter([x]))
        if y is not None and x + y > k and (s is None or y > s):
            return None
    return (w, k) if s is None else (w, k, s)


def reduced(sizes: Sizes, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets, largest items first, until none is left to fix; `sizes` keeps the remainder."""
    out, changed = [], True
    while changed:
        changed = False
        for w in sorted(sizes.left, reverse=True):
            while sizes.left[w] > 0 and (found := dominating(sizes, w, capacity)):
                times = min(sizes.left[s] // n for s, n in Counter(found).items())
                out.append((found, times))
                for s, n in Counter(found).items():
                    sizes.take([s], times * n)
                changed = True
    return out


def best_fit(sizes: Sizes, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, largest items first, over groups of bins that are filled alike."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, items: tuple[int, ...], bins: int) -> None:
        if bins:
            if room not in open_bins:
                insort(rooms, room)
            open_bins.setdefault(room, []).append((items, bins))

    for w in sorted(sizes.left, reverse=True):
        n = sizes.left[w]
        while n:
            at = bisect_left(rooms, w)
            if at == len(rooms):
                room, items, bins = capacity, (), -(-n // (capacity // w))
            else:
                room = rooms[at]
                items, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            each = room // w  # once opened for w, a bin stays the best fit until it is full
            full, rest = min(bins, n // each), 0
            if full < bins:
                rest = n - full * each
                put(room - rest * w, items + (w,) * rest, int(rest > 0))
                put(room, items, bins - full - (rest > 0))
            put(room - each * w, items + (w,) * each, full)
            n -= full * each + rest
    return [group for groups in open_bins.values() for group in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences) that hold all pieces."""
    sizes = Sizes(counts)
    return reduced(sizes, capacity) + best_fit(sizes, capacity)


class Places:
    """For the r-th piece of a length: its sequence and its offset there."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]]):
        rows, used, first = [], Counter(), 0
        for items, times in planned:
            offset = 0
            for size, n in Counter(items).items():
                rows.append((size, used[size], first, n, offset))
                used[size] += times * n
                offset += n * size
            first += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.sizes, self.ranks, self.first, self.each, self.offset = table.T.copy()
        self.key = (self.sizes << 48) + self.ranks

    def of(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (size << 48) + rank, side="right") - 1
        sequence, within = np.divmod(rank - self.ranks[at], self.each[at])
        return self.first[at] + sequence, self.offset[at] + within * size


def ranked(cut: DataFrame, total: int) -> DataFrame:
    """Number the pieces of each length from 0, as rank; a frequent length is numbered in many parts."""
    parts = max(1, -(-total // RANKED_TOGETHER))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("length", "part").count().select(
        F.col("length").alias("of_length"), F.col("part").alias("of_part"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"),
    )
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = cut.withColumn("own", F.row_number().over(own) - 1)
    return (
        numbered.join(counts, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part")))
        .withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "part", "of_length", "of_part")
    )


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset, in few sequences of at most `capacity` tokens."""
    cut = staged(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    places = Places(plan(counts, capacity))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            size, rank = columns["length"].to_numpy(), columns.pop("rank").to_numpy()
            sequence, offset = places.of(size, rank)
            yield {**columns, "sequence_id": pa.array(sequence), "offset": pa.array(offset)}

    numbered = ranked(cut, sum(counts.values()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return arrow_map(numbered, run, schema)
