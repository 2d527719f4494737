"""Merkle manifest of documents: a tree of threes for each source, one over the sources, and a proof for each row.

Proofs are multiproofs, one for each leaf partition: a run of rows in the order of the manifest, in whole blocks.
A partition works out which nodes it lacks to climb to the root (`octopus`), fetches these once, derives all
shared interior nodes from its own leaves, and expands the proof of each row from them.

Nulls have a mark of their own in a leaf, so null and empty differ; texts are hashed whole, however long. Rows of
one source stand by doc_id (null first), then by leaf; rows that are equal in all five columns have equal leaves
and stand next to each other, each with its own proof. A null doc_id is never `altered` by `tampered`. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backlog.llm.common import arrow_map, staged

#: Nodes of a run.
ARITY = 3
#: The tree over the sources; theirs are numbered from 0.
TOP = -1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
INNER, GOES_ON, ROOT = range(3)


@dataclass(frozen=True)
class Settings:
    """Levels of a block, which is hashed in one place, and rows of a leaf partition at most (give or take a block).

    There are at least as many leaf partitions as the session has shuffle partitions.
    """

    levels: int = 5
    partition_rows: int = 200_000

    @property
    def block(self) -> int:
        return ARITY**self.levels


def node(digests: Iterable[bytes]) -> bytes:
    """The digest of a run of digests, all as hexadecimal text."""
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def leaf(**replaced: Column) -> Column:
    """The digest of a row, as 32 bytes, with some columns replaced."""
    values = [replaced.get(c, F.col(c)).cast("string") for c in COLUMNS]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def octopus(known: np.ndarray, size: int, level: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(level, places) of the fewest nodes that, with those at the places `known`, give the root.

    `size`: the tree's nodes at the level that `known` is of.
    """
    while size > 1:
        parents = np.unique(known // ARITY)
        runs = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        missing = np.setdiff1d(runs[runs < size], known, assume_unique=True)
        if len(missing):
            yield level, missing
        known, size, level = parents, -(-size // ARITY), level + 1


def climbed(own: dict[int, bytes], fetched: dict[tuple[int, int], bytes], size: int) -> tuple[bytes, dict[int, tuple]]:
    """The root; and for each own leaf the digests before and after it in its run, level by level.

    All proofs share the nodes above: each is worked out once.
    """
    levels, level = [], 0
    while size > 1:
        sides, above = {}, {}
        for parent in dict.fromkeys(place // ARITY for place in own):
            run = range(parent * ARITY, min(size, parent * ARITY + ARITY))
            digests = [own[p] if p in own else fetched[level, p] for p in run]
            above[parent] = node(digests)
            for k, p in enumerate(run):
                if p in own:
                    sides[p] = (b"".join(digests[:k]), b"".join(digests[k + 1:]))
        levels.append(sides)
        own, size, level = above, -(-size // ARITY), level + 1
    paths: dict[int, tuple] = {0: ()}
    for sides in reversed(levels):
        paths = {p: (side, *paths[p // ARITY]) for p, side in sides.items()}
    return own[0], paths


def folded(digest: bytes, path: Iterable[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        digest = node((before, digest, after))
    return digest


def built(digests: list[bytes], alone: bool, levels: int) -> list[list[bytes]]:
    """A block level by level; the only block of a tree ends at its root, any other has all levels."""
    out = [digests]
    while len(out) <= levels and not (alone and len(out[-1]) == 1):
        out.append([node(out[-1][k:k + ARITY]) for k in range(0, len(out[-1]), ARITY)])
    return out


def _placed(leaves: DataFrame, settings: Settings) -> tuple[DataFrame, int, int]:
    """(tree, place, bucket, doc_id, leaf, altered) of all rows; how many trees and how many leaf partitions there are.

    Rows are sorted by ranges, so a source of any size spreads over many tasks. A task numbers the rows of each
    of its sources; where the first of them begins, comes from one row for each task.
    """
    leaves = staged(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    n = leaves.count()
    parts = max(int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // settings.partition_rows))
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("row").asc()]

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        part, at, stretch, seq, last = TaskContext.get().partitionId(), 0, -1, 0, None
        for batch in batches:
            stretches, seqs = [], []
            for source in batch.column(0).to_pylist():
                if stretch < 0 or source != last:
                    stretch, seq, last = stretch + 1, 0, source
                stretches.append(stretch)
                seqs.append(seq)
                seq += 1
            rows = range(at, at := at + batch.num_rows)
            columns = dict(zip(("source", "doc_id", "leaf", "altered"), batch.columns))
            yield columns | {"part": [part] * len(seqs), "at": list(rows), "stretch": stretches, "seq": seqs}

    schema = "source string, doc_id long, leaf binary, altered binary, part int, at long, stretch long, seq long"
    dealt = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("source", "doc_id", "leaf", "altered")
    rows = staged(arrow_map(dealt, number, schema), "merkle-rows")
    starts, trees = _starts(rows)
    known = F.broadcast(rows.sparkSession.createDataFrame(starts, "of int, tree0 long, place0 long, before long"))  # a row for each task
    place = F.col("seq") + F.when(F.col("stretch") == 0, F.col("place0")).otherwise(0)
    first = F.col("before") + F.col("at") - F.col("place")  # the first row of the tree, counted over all rows
    first = first + F.col("place") - F.col("place") % settings.block  # of the block
    return rows.join(known, F.col("part") == F.col("of")).withColumn("place", place).select(
        (F.col("tree0") + F.col("stretch")).alias("tree"), "place", F.floor(first * parts / max(n, 1)).cast("int").alias("bucket"),
        "doc_id", "leaf", "altered",
    ), trees, parts


def _starts(rows: DataFrame) -> tuple[list[tuple[int, int, int, int]], int]:
    """(part, tree of its first row, that row's place, rows before it) for each task; and the number of trees."""
    ends = rows.groupBy("part").agg(
        F.min(F.struct("stretch", "source")).alias("first"), F.max(F.struct("stretch", "seq", "source")).alias("last"), F.count("*").alias("n"),
    ).orderBy("part").collect()
    out, before, tree, source, held = [], 0, -1, None, 0
    for end in ends:
        goes_on = tree >= 0 and end["first"]["source"] == source
        tree, place = (tree, held) if goes_on else (tree + 1, 0)
        out.append((end["part"], tree, place, before))
        before += end["n"]
        held = end["last"]["seq"] + 1 + (place if end["last"]["stretch"] == 0 else 0)
        tree, source = tree + end["last"]["stretch"], end["last"]["source"]
    return out, tree + 1


def _grown(leaves: DataFrame, settings: Settings, from_leaves: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tree, level, place, digest) of inner nodes; the roots, alike; and the tops of the blocks of leaves.

    Blocks of a level are hashed apart, their tops make up the next blocks: a round for each so many levels.
    `from_leaves`: whether nodes below the tops of the first blocks are wanted too.
    """
    now = leaves.withColumn("level", F.lit(0))
    rounds = []
    while True:
        inner = from_leaves or bool(rounds)

        def run(batches: Iterable[pa.RecordBatch], inner: bool = inner) -> Iterator[dict]:
            def done(key: tuple[int, int, int], digests: list[bytes]) -> dict:
                tree, level, block = key
                alone = block == 0 and len(digests) < settings.block
                levels = built(digests, alone, settings.levels)
                rows = [
                    (tree, level + up, block * settings.block // ARITY**up + k, d, INNER, 0)
                    for up, of in enumerate(levels[:-1]) for k, d in enumerate(of)
                ] if inner else []
                up = len(levels) - 1
                rows.append((tree, level + up, block * settings.block // ARITY**up, levels[-1][0], ROOT if alone else GOES_ON, len(digests)))
                return dict(zip(("tree", "level", "place", "digest", "kind", "size"), map(list, zip(*rows))))

            key, digests = None, []
            for batch in batches:
                for tree, level, place, digest in zip(*(c.to_pylist() for c in batch.columns)):
                    if key != (tree, level, place // settings.block):
                        if digests:
                            yield done(key, digests)
                        key, digests = (tree, level, place // settings.block), []
                    digests.append(digest)
            if digests:
                yield done(key, digests)

        dealt = now.select("tree", "level", "place", "digest").repartition("tree", F.floor(F.col("place") / settings.block))
        rows = arrow_map(dealt.sortWithinPartitions("tree", "place"), run, "tree long, level int, place long, digest binary, kind int, size long")
        rounds.append(staged(rows, f"merkle-level-{len(rounds) * settings.levels}"))
        now = rounds[-1].where(F.col("kind") == GOES_ON)
        if now.isEmpty():
            break
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    columns = ["tree", "level", "place", "digest"]
    blocks = rounds[0].where(F.col("kind") != INNER)
    return nodes.where(F.col("kind") == INNER).select(*columns), nodes.where(F.col("kind") == ROOT).select(*columns), blocks


def _wanted(blocks: DataFrame, trees: int, settings: Settings) -> DataFrame:
    """What each leaf partition (bucket) fetches: (bucket, tree, level, place), and with level -1 a tree's size as place.

    A partition holds whole blocks, so it lacks nothing below their tops.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        def done(bucket: int, held: dict[int, tuple[int, list[int]]]) -> dict:
            rows = [(bucket, tree, -1, size) for tree, (size, _) in held.items()]
            for tree, (size, places) in held.items():
                for level, missing in octopus(np.array(places), -(-size // settings.block), settings.levels):
                    rows += [(bucket, tree, level, p) for p in missing.tolist()]
            for level, missing in octopus(np.array(sorted(held)), trees):
                rows += [(bucket, TOP, level, p) for p in missing.tolist()]
            return dict(zip(("bucket", "tree", "level", "place"), map(list, zip(*rows))))

        own, held = None, {}
        for batch in batches:
            for bucket, tree, block, size in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != own:
                    if held:
                        yield done(own, held)
                    own, held = bucket, {}
                held.setdefault(tree, (size, []))[1].append(block)
        if held:
            yield done(own, held)

    dealt = blocks.select("bucket", "tree", "block", "size").repartition("bucket").sortWithinPartitions("bucket", "tree", "block")
    return arrow_map(dealt, run, "bucket int, tree long, level int, place long")


def _expanded(rows: DataFrame, trees: int) -> DataFrame:
    """A proof for each leaf, from the leaves and fetched nodes of its partition."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        def done(sizes: dict, fetched: dict, leaves: dict) -> Iterator[dict]:
            climbs = {tree: climbed({p: r[1] for p, r in own.items()}, fetched.get(tree, {}), sizes[tree]) for tree, own in leaves.items()}
            root, above = climbed({tree: subroot for tree, (subroot, _) in climbs.items()}, fetched.get(TOP, {}), trees)
            for tree, own in leaves.items():
                subroot, paths = climbs[tree]
                out = []
                for place, (doc_id, digest, altered) in own.items():
                    path = paths[place] + above[tree]
                    again = folded(altered or digest, path)
                    proof = hashlib.sha256(b"".join(d for sides in path for d in sides)).hexdigest()
                    out.append((doc_id, digest.decode(), subroot.decode(), root.decode(), proof, again.decode(), again == root))
                yield dict(zip(("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"), map(list, zip(*out))))

        bucket, sizes, fetched, leaves = None, {}, {}, {}
        for batch in batches:
            for own, level, tree, place, digest, doc_id, altered in zip(*(c.to_pylist() for c in batch.columns)):
                if own != bucket:
                    if leaves:
                        yield from done(sizes, fetched, leaves)
                    bucket, sizes, fetched, leaves = own, {}, {}, {}
                if level is None:
                    leaves.setdefault(tree, {})[place] = (doc_id, digest.hex().encode(), altered.hex().encode() if altered else None)
                elif level < 0:
                    sizes[tree] = place
                else:
                    fetched.setdefault(tree, {})[level, place] = digest
        if leaves:
            yield from done(sizes, fetched, leaves)

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return arrow_map(rows, run, schema)


def tampered() -> Column:
    """The text without line ends where 2 divides the checksum of doc_id; otherwise as it is."""
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def audited(docs: DataFrame, now: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of the documents.

    `now`: the texts as they are found at the audit, by default `tampered()`; the manifest is of `docs` as they are.
    """
    now = tampered() if now is None else now
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in COLUMNS[1:]])
    same = now.eqNullSafe(F.col("text"))
    placed, trees, parts = _placed(own.select("source", "doc_id", leaf().alias("leaf"), F.when(~same, leaf(text=now)).alias("altered")), settings)
    rows = staged(placed, "merkle-placed")
    inner, roots, tops = _grown(rows.select("tree", "place", F.lower(F.hex("leaf")).cast("binary").alias("digest")), settings, from_leaves=False)
    # The roots of the sources, in their order, are the leaves of the tree over them.
    over, _, _ = _grown(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "digest"), settings, from_leaves=True)
    store = staged(inner.unionByName(over), "merkle-nodes")
    in_bucket = rows.where(F.col("place") % settings.block == 0).select("tree", "bucket", F.floor(F.col("place") / settings.block).alias("block"))
    sizes = tops.groupBy("tree").agg(F.sum("size").alias("size")).withColumnRenamed("tree", "of")
    blocks = in_bucket.join(sizes, F.col("tree") == F.col("of"))
    wanted = staged(_wanted(blocks, trees, settings), "merkle-wanted")
    asked = wanted.where("level >= 0").select("bucket", *[F.col(c).alias(f"{c}_") for c in ("tree", "level", "place")])
    fetched = store.join(asked, [F.col(c) == F.col(f"{c}_") for c in ("tree", "level", "place")]).select("bucket", "level", "tree", "place", "digest")
    notes = wanted.where("level < 0").select("bucket", "level", "tree", "place", F.lit(None).cast("binary").alias("digest"))
    leaves = rows.select("bucket", F.lit(None).cast("int").alias("level"), "tree", "place", F.col("leaf").alias("digest"), "doc_id", "altered")
    together = staged(fetched.unionByName(notes), "merkle-fetched").unionByName(leaves, allowMissingColumns=True)
    # By ranges, as buckets are few numbers and hashing would put several into one task and none into others.
    ordered = together.repartitionByRange(parts, "bucket").sortWithinPartitions("bucket", F.col("level").asc_nulls_last(), "tree", "place")
    return _expanded(ordered.select("bucket", "level", "tree", "place", "digest", "doc_id", "altered"), trees)
