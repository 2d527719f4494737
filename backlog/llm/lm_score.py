"""Masked pseudo-likelihood: how well a network guesses each word from the words on both sides of it.

A word's probability is that of its class, given by the network, times its share of the class, counted over
the corpus. Classes hold frequent words of about equal mass; words outside the vocabulary are a class of their
own and share it evenly. A document's score is the sum of the log-probabilities of all its words.

Null and empty texts have no words: n_tokens 0, score 0, mean null. Texts are read whole, however long. Of words
equally frequent at the edge of the vocabulary, the first in order is in it. Repeated rows are scored alike. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backlog.llm.common import arrow_map, staged
from backlog.llm.words import word_counts

FAN_IN = 16


@dataclass(frozen=True)
class Settings:
    """Vocabulary size, classes, window on each side, widths; one word in `masked` of every document is masked
    together, until in all rounds each has been once; every round trains in every task from the same start and
    averages what the tasks have learned."""

    vocabulary: int = 16_384
    classes: int = 32
    window: int = 2
    embedding: int = 16
    hidden: int = 32
    masked: int = 16
    rounds: int = 1
    batch: int = 4096
    rate: float = 0.05


class Vocabulary:
    """Numbers of the frequent words, their classes, and log-shares within the class."""

    def __init__(self, words: list[str], counts: list[int], rare_tokens: int, rare_words: int, classes: int):
        n = len(words)
        self.numbers = {w: k for k, w in enumerate(words)}
        self.rare, self.edge = n, n + 1
        mass = np.cumsum(np.sqrt(np.array(counts, float))) if n else np.zeros(0)
        kind = np.minimum((mass / max(mass[-1], 1) * (classes - 1)).astype(int), classes - 2) if n else np.zeros(0, int)
        self.kind = np.append(kind, classes - 1)
        totals = np.bincount(kind, counts, classes) if n else np.zeros(classes)
        share = np.log(np.array(counts, float) / totals[kind]) if n else np.zeros(0)
        self.log_share = np.append(share, -np.log(rare_words + 1.0))
        totals[classes - 1] = rare_tokens
        self.class_share = (totals + 1) / (totals.sum() + classes)

    def ids(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        return np.fromiter(map(self.numbers.get, words, repeat(self.rare)), np.int64, len(words))


def vocabulary(docs: DataFrame, settings: Settings = Settings()) -> Vocabulary:
    """Counts over all documents; the driver gets the most frequent words, at most settings.vocabulary."""
    counts = staged(word_counts(docs), "lm-words")
    top = counts.orderBy(F.desc("n"), "word").limit(settings.vocabulary).collect()
    words, tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rare = tokens - sum(r.n for r in top)
    return Vocabulary([r.word for r in top], [r.n for r in top], rare, words - len(top), settings.classes)


class Network:
    """Embeddings of the window's words, one hidden layer, a softmax over classes."""

    NAMES = ("embedding", "w1", "b1", "w2", "b2")

    def __init__(self, settings: Settings, vocabulary: Vocabulary):
        s, rng = settings, np.random.default_rng(0)
        fan = 2 * s.window * s.embedding
        self.settings = s
        self.embedding = rng.normal(0, 0.3, (vocabulary.edge + 1, s.embedding)).astype(np.float32)
        self.w1 = rng.normal(0, fan ** -0.5, (fan, s.hidden)).astype(np.float32)
        self.b1 = np.zeros(s.hidden, np.float32)
        self.w2 = rng.normal(0, 0.1, (s.hidden, s.classes)).astype(np.float32)
        self.b2 = np.log(vocabulary.class_share).astype(np.float32)

    def state(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, state: np.ndarray) -> "Network":
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, state[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def offsets(self) -> np.ndarray:
        w = self.settings.window
        return np.array([*range(-w, 0), *range(1, w + 1)])

    def learn(self, padded: np.ndarray, at: np.ndarray, kind: np.ndarray) -> None:
        """One pass over the masked places `at`, in batches, with AdaGrad."""
        s = self.settings
        seen = {n: np.full(getattr(self, n).shape, 1e-4, np.float32) for n in self.NAMES}
        small = np.uint16 if len(self.embedding) <= 1 << 16 else np.int64  # short numbers are sorted by their digits

        def step(name: str, g: np.ndarray, rows=slice(None)) -> None:
            past = seen[name][rows] + g * g
            seen[name][rows] = past
            getattr(self, name)[rows] -= s.rate * g / np.sqrt(past)

        for k in range(0, len(at), s.batch):
            ids = padded[at[k:k + s.batch, None] + self.offsets()]
            n = len(ids)
            x = self.embedding[ids].reshape(n, -1)
            h = np.maximum(x @ self.w1 + self.b1, 0)
            z = h @ self.w2 + self.b2
            z -= z.max(1, keepdims=True)
            p = np.exp(z, out=z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), kind[k:k + s.batch]] -= 1
            p /= n
            dh = (p @ self.w2.T) * (h > 0)
            dx = (dh @ self.w1.T).reshape(-1, s.embedding)
            step("w2", h.T @ p)
            step("b2", p.sum(0))
            step("w1", x.T @ dh)
            step("b1", dh.sum(0))
            flat = ids.ravel()
            order = np.argsort(flat.astype(small), kind="stable")
            ordered = flat[order]
            starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            step("embedding", np.add.reduceat(dx[order], starts, axis=0), ordered[starts])

    def scorer(self, vocabulary: Vocabulary):
        """A function giving the log-probability of the words at some places."""
        s = self.settings
        # The first layer's share of each word at each place of the window, worked out once.
        tables = [self.embedding @ self.w1[j * s.embedding:(j + 1) * s.embedding] for j in range(2 * s.window)]

        def score(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
            out = np.empty(len(at))
            for k in range(0, len(at), 16_384):
                part = at[k:k + 16_384]
                h = np.repeat(self.b1[None], len(part), 0)
                for table, d in zip(tables, self.offsets()):
                    h += table[padded[part + d]]
                z = np.maximum(h, 0, out=h) @ self.w2 + self.b2
                own = padded[part]
                chosen = z[np.arange(len(part)), vocabulary.kind[own]]
                top = z.max(1)
                total = np.log(np.exp(z - top[:, None]).sum(1)) + top
                out[k:k + len(part)] = chosen - total + vocabulary.log_share[own]
            return out

        return score


def _padded(texts: list, vocabulary: Vocabulary, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row with edges between them; the places of the words; words per text."""
    edge = np.full(window, vocabulary.edge)
    rows = [vocabulary.ids(t) for t in texts]
    sizes = np.array([len(r) for r in rows], np.int64)
    padded = np.concatenate([edge, *[x for r in rows for x in (r, edge)]])
    starts = window + np.cumsum(sizes + window) - sizes - window
    return padded, np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


def _slices(texts: list, most: int = 2_000_000) -> Iterator[list]:
    """Texts in groups of about `most` characters."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text or "")
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def masked_places(at: np.ndarray, number: int, settings: Settings) -> np.ndarray:
    """The places whose words are masked in a round, those masked together next to each other; each place is in one
    of the rounds."""
    turn = at * 7 % max(settings.masked, settings.rounds)
    mine = turn % settings.rounds == number
    return at[mine][np.argsort(turn[mine], kind="stable")]


def train(docs: DataFrame, words: Vocabulary, settings: Settings = Settings()) -> Network:
    """Federated averaging: all documents take part in every round, each with its masked words."""
    network = Network(settings, words)
    s = settings

    for number in range(s.rounds):
        start = network.state()

        def run(batches: Iterable[pa.RecordBatch], start=start, number=number) -> Iterator[dict]:
            own, places = Network(s, words).load(start), 0
            for batch in batches:
                for texts in _slices(batch.column(0).to_pylist()):
                    padded, at, _ = _padded(texts, words, s.window)
                    mine = masked_places(at, number, s)
                    if len(mine):
                        own.learn(padded, mine, words.kind[padded[mine]])
                        places += len(mine)
            if places:
                yield {"part": [TaskContext.get().partitionId()], "places": [places], "state": [own.state().astype("<f4").tobytes()]}

        models = staged(arrow_map(docs.select("text"), run, "part int, places long, state binary"), "lm-models")
        while models.count() > FAN_IN:  # averages of averages, a bounded number at a time
            models = staged(_averaged(models), "lm-models")
        rows = models.collect()
        if rows:
            total = sum(r.places for r in rows)
            network.load(sum(np.frombuffer(r.state, "<f4").astype(float) * (r.places / total) for r in rows))
    return network


def _averaged(models: DataFrame) -> DataFrame:
    """Weighted averages of FAN_IN neighbours each."""
    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        total = int(rows.places.sum())
        state = sum(np.frombuffer(x, "<f4").astype(float) * (n / total) for x, n in zip(rows.state, rows.places))
        return pd.DataFrame({"part": [int(rows.part.min()) // FAN_IN], "places": [total], "state": [state.astype("<f4").tobytes()]})

    return models.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(mean, "part int, places long, state binary")


def scored(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_tokens, pseudo_log_likelihood, mean_log_probability) of every document."""
    words = vocabulary(docs, settings)
    network = train(docs, words, settings)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        score = network.scorer(words)
        for batch in batches:
            n, sums = [], []
            for texts in _slices(batch.column(1).to_pylist()):
                padded, at, sizes = _padded(texts, words, settings.window)
                total = np.concatenate([[0.0], np.cumsum(score(padded, at))])
                ends = np.cumsum(sizes)
                n += sizes.tolist()
                sums += (total[ends] - total[ends - sizes]).tolist()
            yield {
                "doc_id": batch.column(0), "n_tokens": n, "pseudo_log_likelihood": sums,
                "mean_log_probability": [x / k if k else None for x, k in zip(sums, n)],
            }

    schema = "doc_id long, n_tokens long, pseudo_log_likelihood double, mean_log_probability double"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)
