from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
import corpus_pipeline
from backlog.llm import decontaminate, packing, quality, secret_scan, simhash
from backlog.llm.queries import llm_queries, llm_sql

PATH = "/root/testdata/sf0.001"


def test_registered():
    names = list(llm_queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
    assert set(names) <= set(entry_points.queries()) and set(llm_sql()) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(llm_sql()))
def test_sql(spark, name):
    assert differences(llm_queries()[name](spark, PATH), connect(PATH), llm_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in llm_queries() if n not in llm_sql()])
def test_every_document_has_a_row(spark, documents, name):
    out = llm_queries()[name](spark, PATH)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()} - {None}
    everyone = {r.doc_id for r in documents.select("doc_id").collect()}
    assert ids <= everyone
    if name not in ("op6_passages", "op7_decontamination", "pipeline"):
        assert ids == everyone


def by_hand(docs, benchmark, refs):
    """The rows of documents that the first four stages keep, one after the other, without Spark."""
    rules, kept = quality.Rules(), []
    for r in docs:
        base, words = quality.base_counts(r.text, rules)
        if base[-1]:
            continue
        ref = refs.get(r.lang or "", refs.get(None))
        h = quality.char_histogram(r.text)
        far = quality.divergence(h / h.sum(), ref.chars) ** 0.5 > rules.max_char_distance if len(r.text) >= rules.min_chars_compared else False
        odd = quality.word_divergence(words, ref.words) ** 0.5 > rules.max_word_distance if len(words) >= rules.min_words_compared else False
        if not far and not odd:
            kept.append(r)
    prints, out = [simhash.fingerprint(r.text) for r in kept], []
    group = list(range(len(kept)))
    for _ in kept:
        for a in range(len(kept)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
    for k, r in enumerate(kept):
        if r.doc_id == min(x.doc_id for j, x in enumerate(kept) if group[j] == group[k]):
            out.append(r)
    items = decontaminate.Block([(b.item_id, decontaminate.tokens_of(b.text)) for b in benchmark], decontaminate.Settings())
    return {r.doc_id: secret_scan.redact(r.text) for r in out if not items.matches(r.text)}


def test_stages(spark, documents):
    bench = spark.read.parquet(f"{PATH}/benchmark.parquet").collect()
    want = by_hand(documents.collect(), bench, quality.references(documents))
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, PATH).cache()
        assert docs.columns == documents.columns and docs.dtypes == documents.dtypes
        assert docs.count() <= before.count()
    assert {r.doc_id: r.text for r in docs.collect()} == want
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = corpus_pipeline.run(spark, PATH).collect()
    assert {r.doc_id for r in packed} == set(want)
    words = packing.WordIds(packing.public_tokenizers.path("word_bpe_49k.json"))
    assert sum(r.length for r in packed) == sum(len(words.of(t)) // 4 for t in want.values())


def test_stages_over_odd_rows(spark, docs_of, with_clashes, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing columns go through every stage."""
    long = " ".join(f"word{k}" for k in range(60_000))
    docs = with_clashes(docs_of((1, None), (2, ""), (3, long), (3, long), (None, long), (None, None), (4, "token=abcdefgh " + long[:3000])))
    spark.read.parquet(f"{PATH}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    for empty in (docs, docs.limit(0)):
        now = empty
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path)).cache()
            now.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns


def test_nothing_else_imports_the_subpackage():
    root = Path(entry_points.__file__).parent
    for path in (root / "backlog").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()
