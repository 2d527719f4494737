import numpy as np
import pytest

from backlog.llm import lm_score as L
from backlog.llm.words import word_counts

SMALL = L.Settings(vocabulary=50, classes=8, masked=2, rounds=3, batch=256, rate=0.2)


def direct(network, vocabulary, text):
    """Sum of log-probabilities, word by word, by the definition."""
    ids, w, total = vocabulary.ids(text).tolist(), network.settings.window, 0.0
    for k, own in enumerate(ids):
        around = [ids[k + d] if 0 <= k + d < len(ids) else vocabulary.edge for d in network.offsets()]
        h = np.maximum(np.concatenate([network.embedding[a] for a in around]) @ network.w1 + network.b1, 0)
        z = (h @ network.w2 + network.b2).astype(float)
        total += z[vocabulary.kind[own]] - np.log(np.exp(z).sum()) + vocabulary.log_share[own]
    return total


def pattern(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(x for _ in range(n) for x in (("red", "blue", "green")[rng.integers(3)], "sea", "is", "wide"))


def test_scores_against_the_definition(docs_of, with_clashes):
    docs = docs_of(*[(k, pattern(30, k)) for k in range(20)], (90, None), (91, ""), (92, "sea"), (0, pattern(30, 0)), (None, "never seen words"))
    words = L.vocabulary(docs, SMALL)
    network = L.train(docs, words, SMALL)
    again = {(r.doc_id, r.n_tokens): r for r in L.scored(with_clashes(docs), SMALL).collect()}
    assert L.scored(docs, SMALL).count() == 25
    score = network.scorer(words)
    for r in docs.collect():
        padded, at, sizes = L._padded([r.text], words, SMALL.window)
        own = float(score(padded, at).sum())
        assert own == pytest.approx(direct(network, words, r.text), abs=1e-2)
        assert again[r.doc_id, int(sizes[0])].pseudo_log_likelihood == pytest.approx(own, rel=0.05, abs=0.05)
    assert again[90, 0].mean_log_probability is None and again[91, 0].pseudo_log_likelihood == 0


def test_order_is_learned(docs_of):
    """Both sides tell the word: text in order is likelier than the same words shuffled."""
    docs = docs_of(*[(k, pattern(60, k)) for k in range(40)])
    words = L.vocabulary(docs, SMALL)
    network = L.train(docs, words, SMALL)
    text = pattern(50, 99).split()
    shuffled = np.random.default_rng(0).permutation(text)
    score = lambda t: direct(network, words, " ".join(t)) / len(t)
    assert score(text) > score(shuffled) + 0.5


def test_shares_add_up_to_one(docs_of):
    docs = docs_of((1, "a a a b b c d e f g"))
    words = L.vocabulary(docs, L.Settings(vocabulary=4, classes=3))
    p = np.exp(words.log_share[:4])
    for kind in set(words.kind[:4]):
        assert p[words.kind[:4] == kind].sum() == pytest.approx(1)
    assert words.rare == 4 and words.log_share[4] == pytest.approx(-np.log(4))


def test_averages_of_many_models(spark):
    rng = np.random.default_rng(0)
    states, places = rng.normal(size=(40, 5)).astype("<f4"), rng.integers(1, 9, 40)
    models = spark.createDataFrame([(k, int(n), s.tobytes()) for k, (s, n) in enumerate(zip(states, places))], "part int, places long, state binary")
    rows = L._averaged(models).collect()
    assert len(rows) == 3
    mean = sum(np.frombuffer(r.state, "<f4") * r.places for r in rows) / places.sum()
    assert mean == pytest.approx((states * places[:, None]).sum(0) / places.sum(), abs=1e-5)


def test_counts_and_empty_table(docs_of):
    assert {r.word: r.n for r in word_counts(docs_of((1, "A a b"), (2, "b\tB"), (3, None))).collect()} == {"a": 2, "b": 3}
    assert L.scored(docs_of(), SMALL).count() == 0


def test_every_place_is_masked_once():
    at = np.flatnonzero(np.random.default_rng(0).random(5_000) < 0.9)
    for masked, rounds in ((16, 2), (16, 1), (2, 3), (5, 4), (16, 16)):
        taken = np.concatenate([L.masked_places(at, k, L.Settings(masked=masked, rounds=rounds)) for k in range(rounds)])
        assert sorted(taken.tolist()) == at.tolist()


def test_long_texts_and_ties(docs_of):
    """A text of many slices is scored as a whole; of words equally frequent the first is in the vocabulary."""
    docs = docs_of((1, "a b c d " * 200_000), (2, "a b c d " * 100))
    settings = L.Settings(vocabulary=3, classes=4, batch=1024)
    assert set(L.vocabulary(docs, settings).numbers) == {"a", "b", "c"}
    out = {r.doc_id: r for r in L.scored(docs, settings).collect()}
    assert out[1].n_tokens == 800_000 and out[1].mean_log_probability == pytest.approx(out[2].mean_log_probability, abs=0.05)
