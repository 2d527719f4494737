import numpy as np
import pytest

from backlog.llm import decontaminate as D


def brute_tiles(p, t, shortest):
    """Greedy string tiling by its definition: all maximal free matches, longest first."""
    free_p, free_t, covered = [True] * len(p), [True] * len(t), 0
    while True:
        best, matches = 0, []
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] != 0 and free_p[i + k] and free_t[j + k]:
                    k += 1
                if k > best:
                    best, matches = k, []
                if k == best and k:
                    matches.append((i, j))
        if best < shortest:
            return covered
        for i, j in matches:
            if all(free_p[i:i + best]) and all(free_t[j:j + best]):
                free_p[i:i + best] = free_t[j:j + best] = [False] * best
                covered += best


@pytest.mark.parametrize("seed", range(30))
def test_tiles_against_the_definition(seed):
    rng = np.random.default_rng(seed)
    p = rng.integers(1, 6, 30).tolist()
    t = [*rng.integers(0, 6, 15), *p[10:22], *rng.integers(0, 6, 10), *p[:9], 0, *p[20:]]
    found = D.tiles(p, [int(x) for x in t], 3)
    assert all(p[a:a + n] == t[b:b + n] and n >= 3 for a, b, n in found)
    used_p = [x for a, _, n in found for x in range(a, a + n)]
    used_t = [x for _, b, n in found for x in range(b, b + n)]
    assert len(set(used_p)) == len(used_p) and len(set(used_t)) == len(used_t)
    assert len(used_p) == brute_tiles(p, t, 3)
    assert [n for *_, n in found] == sorted((n for *_, n in found), reverse=True)


ITEM = "which of these seven rivers flows north through four countries before it reaches the cold sea at last"


def test_reordered_and_partial_passages(spark, docs_of, with_clashes):
    w = ITEM.split()
    texts = {
        1: f"before {ITEM} after", 2: " ".join(w[9:] + ["in", "between"] + w[:9]), 3: ITEM.upper().replace(" ", ", "),
        4: " ".join(w[:6]) + " something else entirely", 5: "nothing in common here at all", 6: " ".join(sorted(w)), 7: None, 8: "",
    }
    bench = spark.createDataFrame([(10, ITEM), (10, ITEM), (11, "too short"), (12, None), (13, "")], "item_id long, text string")
    docs = with_clashes(docs_of(*texts.items(), (1, texts[1])))
    out = D.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [(1, 10), (1, 10), (2, 10), (3, 10)]
    assert {r.doc_id: len(r.tiles) for r in out} == {1: 1, 2: 2, 3: 1}
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7, 8]
    for block in (40, 1):  # however the benchmark is cut
        s = D.Settings(block_tokens=block)
        assert sorted((r.doc_id, r.item_id) for r in D.contaminated(docs, bench, s).collect()) == [(1, 10), (1, 10), (2, 10), (3, 10)]


def test_documents(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.coverage for r in D.contaminated(documents, bench).collect()}
    for d in documents.collect():
        for b in bench.collect():
            numbers = {}
            p = [numbers.setdefault(x, len(numbers) + 1) for x in D.tokens_of(b.text)]
            t = [numbers.get(x, 0) for x in D.tokens_of(d.text)]
            seeds = {tuple(p[k:k + 4]) for k in range(len(p) - 3)}
            if not any(tuple(t[k:k + 4]) in seeds for k in range(len(t) - 3)):
                assert (d.doc_id, b.item_id) not in got
                continue
            share = brute_tiles(p, t, 4) / len(p)
            assert got.get((d.doc_id, b.item_id)) == (pytest.approx(share) if share >= 0.6 else None)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(docs_of((1, ITEM)), none).count() == 0 and D.clean(docs_of((1, ITEM)), none).count() == 1
    assert D.contaminated(docs_of(), spark.createDataFrame([(1, ITEM)], "item_id long, text string")).count() == 0


def test_short_items_must_be_there_whole():
    items = [(1, "what river flows through paris".split()), (2, "one two three".split()), (3, "a b c d e f g".split())]
    block = D.Block(items, D.Settings())
    found = lambda text: [i for i, _, _ in block.matches(text)]
    assert found("So: what river flows through Paris? The Seine.") == [1]
    assert found("what river flows through london") == [] and found("river flows through paris") == []
    assert found("one two three") == [] and found("x a b c d e f g y") == [3] and found("a b c d x e f g") == []


def test_very_long_texts():
    item = [f"t{k}" for k in range(40)]
    block = D.Block([(1, item)], D.Settings())
    text = " ".join(f"w{k}" for k in range(300_000))
    assert block.matches(f"{text} {' '.join(item[20:])} {text[:1000]} {' '.join(item[:20])}")[0][:2] == (1, 1.0)
    assert block.matches(text) == []
