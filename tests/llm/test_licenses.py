import random
import re
from collections import Counter

import pytest

from backlog.llm import licenses

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
FLAT = {w: 1.0 for w in licenses.vocabulary(licenses.templates())}


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_by_hand(text):
    words = WORD.findall(lowered(text))
    places = sorted((k, label) for phrase, label in PHRASES.items() for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split())
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def base_of(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels


@pytest.fixture(scope="module")
def index():
    return licenses.Index(FLAT)


def labels(index, text):
    return {t.label for t, _, _ in index.found(licenses.words_of(text))}


def test_words():
    text = "Ab1c-D9_é Ñ\x00x0[y`z{w\x7fv/u:t@ \U0001F600"
    assert [w.decode() for w in licenses.words_of(text)] == WORD.findall(lowered(text))


def test_base_against_brute_force(spark, documents):
    out = licenses.scan(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(out) == len(texts)
    for r in out:
        assert base_of(r) == base_by_hand(texts[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")


def test_rarity(documents):
    """Document frequencies over all documents, against a count by hand."""
    known = licenses.templates()
    idf = licenses.rarity(documents, known)
    texts = [set(licenses.words_of(r.text)) for r in documents.collect()]
    for word in licenses.vocabulary(known):
        n = sum(word in t for t in texts)
        assert idf[word] == pytest.approx(licenses.math.log((len(texts) + 1) / (n + 1)) + 1)


def test_phrases_at_all_places(index):
    rng = random.Random(5)
    pool = "mit license apache general public gnu version 2 0 x".split()
    for _ in range(300):
        text = " ".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        found = Counter((t.label, k) for t, k, _ in index.found(licenses.words_of(text)) if t.slack == 0)
        words = text.split()
        want = Counter(
            (t.label, k) for t in index.known if t.slack == 0 for k in range(len(words))
            if tuple(w.encode() for w in words[k:k + len(t.words)]) == t.words
        )
        assert found == want


@pytest.mark.parametrize("label, notice", [(label, notice) for label, notice, _ in licenses.NOTICES])
def test_notices(index, label, notice):
    """Found whole, in noise, in other spelling and line ends, with some words changed and some added; twice."""
    assert label in labels(index, notice)
    noise = " ".join(f"w{k}" for k in range(500))
    assert label in labels(index, f"{noise} {notice.upper()} {noise}")
    assert label in labels(index, "\n# ".join(notice.split(" ")))
    words = [w.decode() for w in licenses.words_of(notice)]
    keys = next(t.keys for t in index.known if t.label == label)
    free = [k for k in range(1, len(words)) if not any(at < k < at + len(key) for at, key in keys)]
    for k in free:  # anywhere but within a mandatory phrase
        assert label in labels(index, " ".join([*words[:k], "some", "holder", "name", *words[k:]]))
        assert label in labels(index, " ".join([*words[:k - 1], "other", *words[k:]])) or any(at <= k - 1 < at + len(key) for at, key in keys)
    places = [k for t, k, _ in index.found(licenses.words_of(f"{notice} {noise} {notice}")) if t.label == label]
    assert len(places) == 2


def test_mandatory_phrases(index):
    """All words of a notice without one of its key phrases, or in another order, are no notice."""
    for label, notice, keys in licenses.NOTICES:
        words = licenses.words_of(notice)
        shuffled = list(words)
        random.Random(1).shuffle(shuffled)
        assert label not in labels(index, b" ".join(shuffled).decode())
        for key in keys:
            gone = b" ".join(words).decode().replace(key, key.replace(" ", " and ", 1))
            assert label not in labels(index, gone)


def test_a_clean_text_has_no_label(index):
    assert labels(index, "The public may copy this general notice in all copies, with or without a fee, for any purpose.") == set()


def test_odd_rows(docs_of, with_clashes):
    long = "license mit " * 200_000
    docs = docs_of((1, None), (2, ""), (3, long), (3, long), (None, "MIT License"), (None, None), (4, "public license"), (5, "CC BY-NC 4.0"))
    out = licenses.scan(with_clashes(docs)).collect()
    texts = Counter((r.doc_id, base_by_hand(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, base_of(r)) for r in out) == texts
    assert {r.doc_id: r.labels for r in out}[5] == "cc-by-nc-4.0"
    assert licenses.scan(docs.limit(0)).count() == 0
