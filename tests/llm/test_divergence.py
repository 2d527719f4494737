import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from backlog.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least=30, ranks=50):
    docs, counts, everyone = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source, text = r.lang or "", r.source or "", r.text or ""
        everyone[lang].add(source)
        own = Counter(t.translate(LOWER) for t in TERM.findall(text))
        docs[lang].update(own.keys())
        counts[lang, source].update(own)
    out = []
    for lang, sources in everyone.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        v = len(kept)

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (of[t] + 5) // (total + 5 * v) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def got(docs, settings=divergence.Settings()):
    return sorted(tuple(r) for r in divergence.audit(docs, settings).collect())


def test_terms():
    text = "Ab1cD-é_ñ ÀB\x00x[y`z{w\x7fv u\U0001F600"
    assert [t.decode() for t in divergence.terms(text)] == [t.translate(LOWER) for t in TERM.findall(text)]


@pytest.mark.parametrize("least", [1, 3, 30])
def test_against_brute_force(documents, least):
    assert got(documents, divergence.Settings(least_docs=least)) == by_hand(documents.collect(), least)


def test_blocks_and_buckets(documents):
    """Few sources and terms at once: many blocks meet, in many buckets."""
    settings = divergence.Settings(least_docs=2, terms_at_once=7, sources_at_once=3, ranks=4)
    assert got(documents, settings) == by_hand(documents.collect(), 2, 4)


def test_copies_are_split_once(spark, monkeypatch):
    """A hot text in many sources, in one source often, under one id often: one row each, or one a repeat."""
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("concat('s', id % 7)").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"),
        F.expr("case when id % 3 = 0 then 'Hot text, HOT' when id % 3 = 1 then concat('some word', char(97 + id % 11)) else 'hot other' end").alias("text"),
    )
    rows = rows.unionByName(rows.where("doc_id = 6")).unionByName(rows.where("doc_id = 6")).unionByName(rows.where("doc_id < 50").withColumn("doc_id", F.lit(None).cast("long")))
    texts, groups = divergence.collapsed(rows)
    held = texts.collect()
    assert len({(r.lang, r.text) for r in held}) == 13 and groups.count() == 7
    assert sum(sum(s["n"] for s in r.sources) for r in {(r.lang, r.text): r for r in held}.values()) == rows.count()
    assert all(Counter((r.lang, r.text) for r in held)[r.lang, r.text] == r.repeats for r in held)
    assert got(rows) == by_hand(rows.collect())


def test_odd_rows(docs_of, with_clashes):
    long = " ".join(f"word{chr(97 + k % 26)}" for k in range(200_000))
    docs = docs_of((1, None), (2, ""), (2, ""), (None, "a b a"), (None, "a b a"), (3, long, None), (4, long, "de"), (4, long, "de"), (5, "1 2 3", "fr"))
    docs = docs.withColumn("source", F.expr("case when doc_id = 4 then null when doc_id = 3 then 'é' else source end")).unionByName(
        docs.where("doc_id < 4").withColumn("source", F.lit("other"))
    )
    for least in (1, 2, 30):
        assert got(with_clashes(docs), divergence.Settings(least_docs=least)) == by_hand(docs.collect(), least)
    assert got(docs.limit(0)) == []


def test_terms_over_many_batches(spark, documents):
    """The counts of a term come in many batches, from many tasks that each send theirs in pieces."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(documents, divergence.Settings(least_docs=5)) == by_hand(documents.collect(), 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_block_distances():
    """Any shares, also such that a group's share of an absent term is above another's of a term it holds."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        s, t = int(rng.integers(2, 9)), int(rng.integers(1, 12))
        bases = rng.integers(1, 30, s)
        held = rng.random((t, s)) < 0.4
        value = np.where(held, rng.integers(1, 60, (t, s)), bases)
        left = int(rng.integers(1, s + 1))
        right = 0 if left == s else left
        want = sum(np.abs(value[k, :left, None] - value[k, None, right:]) for k in range(t)) - t * np.abs(bases[:left, None] - bases[None, right:])
        term, source = np.nonzero(held)
        assert (divergence.block_distances(bases, term, source, value[term, source], left, right) == want).all()
