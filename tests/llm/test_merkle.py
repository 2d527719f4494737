import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from backlog.llm import merkle

SMALL = merkle.Settings(levels=1, partition_rows=7)


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text) -> str:
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k:k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, place):
    out = []
    for level in levels[:-1]:
        first = place // 3 * 3
        out.append(("".join(level[first:place]), "".join(level[place + 1:first + 3])))
        place //= 3
    return out


def by_hand(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    sources = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: tree_of([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in sources}
    top = tree_of([built[s][-1][0] for s in sources])
    root, out = top[-1][0] if sources else None, []
    for rank, s in enumerate(sources):
        for place, (_, _, leaf, r) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            steps = path(built[s], place) + path(top, rank)
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            now = leaf_of(r, text)
            for before, after in steps:
                now = h(before + now + after)
            proof = h("".join(a + b for a, b in steps))
            out.append((r.doc_id, leaf, built[s][-1][0], root, proof, now, now == root))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("settings", [merkle.Settings(), SMALL, merkle.Settings(levels=2, partition_rows=20)])
def test_against_brute_force(spark, documents, settings):
    out = got(merkle.audited(documents, settings=settings))
    assert out == by_hand(documents.collect())
    assert {r[-1] for r in out} == {True, False}


def test_sizes_of_sources(spark):
    """Sources of one to a hundred rows, so runs of all lengths end a level; one source has most rows."""
    rows = spark.range(700).select(
        F.col("id").alias("doc_id"), F.expr("case when id % 2 = 0 then 'hot' else concat('s', cast(sqrt(id) as int)) end").alias("source"),
        F.lit("en").alias("lang"), F.lit(3).cast("long").alias("n_chars"), F.concat(F.lit("a\n"), F.col("id").cast("string")).alias("text"),
    )
    assert got(merkle.audited(rows, settings=SMALL)) == by_hand(rows.collect())


def test_odd_rows(spark, docs_of, with_clashes):
    """Nulls in any column, empty and long texts, repeated rows, a source that sorts by bytes."""
    long = "word\n" * 300_000
    rows = [(1, None, "en"), (2, "", "en"), (2, "", "en"), (None, "a\nb", None), (None, None, None), (4, long, "de"), (4, long, "de"), (6, "x\n", None)]
    docs = docs_of(*rows).withColumn("source", F.expr("case when doc_id = 1 then null when doc_id = 4 then 'é' when doc_id = 6 then '' else source end"))
    docs = docs.withColumn("n_chars", F.expr("case when doc_id = 2 then null else n_chars end"))
    for settings in (merkle.Settings(), SMALL):
        assert got(merkle.audited(with_clashes(docs), settings=settings)) == by_hand(docs.collect())
    assert got(merkle.audited(docs.limit(1))) == by_hand(docs.limit(1).collect())
    empty = merkle.audited(docs.limit(0))
    assert empty.count() == 0 and "verified" in empty.columns


def test_any_change_is_found(spark, documents):
    """Texts as they were are verified, one changed character is not."""
    same = merkle.audited(documents, F.col("text"))
    assert same.where("not verified").count() == 0
    changed = merkle.audited(documents, F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text")))
    assert {r.doc_id for r in changed.where("not verified").collect()} == {r.doc_id for r in documents.collect() if r.doc_id % 10 == 0}


def test_octopus_is_least():
    """Every node asked for is needed, is not above a known leaf, and no more are asked for than one proof at a time would."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        size = int(rng.integers(1, 200))
        known = np.unique(rng.integers(0, size, int(rng.integers(1, 20))))
        asked = {(level, p) for level, places in merkle.octopus(known, size) for p in places.tolist()}
        above = {(level, p // 3**level) for level in range(6) for p in known.tolist()}
        single = set()
        for p in known.tolist():
            single |= {(level, q) for level, places in merkle.octopus(np.array([p]), size) for q in places.tolist()}
        assert asked == single - above
