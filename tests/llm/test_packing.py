import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from backlog.llm import packing as P

PATH = P.public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    return P.WordIds(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def want(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def got(words, text):
    return np.frombuffer(words.of(text), "<u4").tolist()


ODD = [
    None, "", " ", "don't stop 'tis the'll", "(\"'s x')", "ΑΣ ΣΑΣ. İstanbul İ- ßİ'", "äb é, Å", "<|endoftext|> x<|startoftext|>y <|endoftext|>.",
    "abc123 12,5 $%^ ___a_b", "x\xa0y z\x85q\x1cr", "  lead\t\ttab\r\nnl ", "ﬁx ǅ ß ẞ", "日本語テキスト。漢字", "🙂ok🙂,a", "a'b'c ''s", "word " * 900 + "é" * 3000,
]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(words, tokenizer, text):
    assert got(words, text) == want(tokenizer, text)


def test_ids_of_random_texts(words, tokenizer):
    rnd, letters = random.Random(1), "abcsSTtLlreVvmdD'’\"().,!<|>_-0129 \n\té́ßΣσİ中 🙂#"
    for _ in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14)))
        assert got(words, text) == want(tokenizer, text), text


def test_small_cache_gives_the_same(tokenizer):
    small = P.WordIds(PATH, most=5)
    for text in ["a bb, ccc. dd ee ff gg hh", "a bb, zz yy", "a a a"]:
        assert got(small, text) == want(tokenizer, text)


def fewest(items, capacity):
    """Fewest bins by trying everything."""
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + items[k] <= capacity:
                place(k + 1, [*bins[:i], bins[i] + items[k], *bins[i + 1:]])
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best[0]


def holds_all(planned, counts, capacity):
    used = Counter()
    for items, times in planned:
        assert times > 0 and 0 < sum(items) <= capacity
        for s in items:
            used[s] += times
    assert used == Counter(counts)


@pytest.mark.parametrize("seed", range(60))
def test_plan_holds_all_and_reduction_keeps_the_optimum(seed):
    rnd = random.Random(seed)
    capacity = 20
    items = sorted((rnd.randint(3, 20) for _ in range(9)), reverse=True)
    counts = Counter(items)
    planned = P.plan(counts, capacity)
    holds_all(planned, counts, capacity)
    sizes = P.Sizes(counts)
    fixed = sum(times for _, times in P.reduced(sizes, capacity))
    rest = sorted(Counter(sizes.left).elements(), reverse=True)
    assert fixed + fewest(rest, capacity) == fewest(items, capacity)


def test_many_alike():
    counts = {2048: 10**9, 1500: 10**8, 548: 10**8, 700: 10**7, 3: 10**9}
    planned = P.plan(counts)
    holds_all(planned, counts, 2048)
    total = sum(s * n for s, n in counts.items())
    assert sum(times for _, times in planned) <= total // 2048 + 10**7


def check_packed(rows, docs, tokenizer, capacity):
    by_doc = Counter()
    for doc_id, text in docs:
        ids = want(tokenizer, text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at:at + capacity]
            by_doc[doc_id, k, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == by_doc
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
        assert ends[r.sequence_id] <= capacity
    return len(ends)


def test_pack_documents(documents, tokenizer, with_clashes):
    rows = P.pack(with_clashes(documents)).collect()
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    n = check_packed(rows, docs, tokenizer, 2048)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 1


def test_pack_odd_rows(docs_of, tokenizer, monkeypatch):
    monkeypatch.setattr(P, "RANKED_TOGETHER", 3)  # many parts for one length
    docs = [(1, None), (2, ""), (3, "w " * 100), (3, "w " * 100), (None, "a b"), (None, None), *[(k, "x y") for k in range(10, 40)]]
    rows = P.pack(docs_of(*docs), capacity=16).collect()
    check_packed(rows, docs, tokenizer, 16)
    with_ids = P.pack(docs_of((1, "hello there")), with_ids=True).first()
    assert with_ids.ids == want(tokenizer, "hello there")
    assert P.pack(docs_of()).count() == 0


def test_words_of_texts_are_looked_up_once(tokenizer, monkeypatch):
    """Texts of a batch are encoded together, and a word's units once, however they are written and in whatever texts they stand."""
    words, sent = P.WordIds(PATH), []
    own = words.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **more):
            sent.extend(x for text in texts for x in text.split(" "))
            return own.encode_batch_fast(texts, **more)

        def __getattr__(self, name):
            return getattr(own, name)

    words.tokenizer = Counted()
    texts = ["Zorble (zorble), ZORBLE!", None, "", "zorble. x\ty\nzorble"]
    ids, ends = words.of_all(P.pa.array(texts))
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [want(tokenizer, t) for t in texts]
    assert sent.count("zorble") == 1 and not any("zorble" in x.lower() for x in sent if x != "zorble")
    monkeypatch.setattr(P, "LOT", 5)
    assert [x for a, b in P.lots(P.pa.array(texts)) for x in range(a, b)] == [0, 1, 2, 3] and list(P.lots(P.pa.array([], P.pa.string()))) == []
