"""Toxicity: a factorization machine over hashed terms.

Score = logistic(bias + sum of the terms' weights + sum over pairs of terms of the product of their factors),
so a pair of terms, such as an insult and the mention of a group, counts beyond what its two terms add up to.

Null and empty texts have no terms; their score is that of the bias. Repeated rows are scored alike. Labels
that contradict each other for a doc_id count as toxic. Without labels of both kinds the score of every
document is the share of toxic labels (0 without any). An empty table gives an empty result. Other columns
are not read; language, source and ids are no input of a score.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog.llm.common import add_columns, arrow_map

TERM = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """`rows`: the classifier is fitted on at most so many labelled documents, those with the least hash of
    their id. A term is used if `least_docs` of them hold it and its shares among toxic and other documents
    are `least_z` standard errors apart; or `least_z_beside` among the documents that hold such a term, as a
    group's name tells nothing alone, but much beside an insult. Other terms would be learned by heart. Terms
    are hashed to 2 ** hash_bits numbers."""

    rows: int = 16_000
    least_docs: int = 5
    least_z: float = 5.0
    least_z_beside: float = 4.0
    hash_bits: int = 40
    factors: int = 8
    epochs: int = 12
    batch: int = 64
    rate: float = 0.2
    decay: float = 1e-4
    threshold: float = 0.3


def terms(text: str | None) -> set[str]:
    return set(TERM.findall((text or "").lower()))


def hashed(term: str, bits: int) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass")) >> (64 - bits)


class Machine:
    """A trained model: hashes of its terms, a weight and factors for each, and a bias."""

    def __init__(self, settings: Settings, numbers: np.ndarray, bias: float):
        self.settings, self.numbers, self.bias = settings, numbers, bias
        self.weights = np.zeros(len(numbers), np.float32)
        self.factors = np.random.default_rng(0).normal(0, 0.02, (len(numbers), settings.factors)).astype(np.float32)

    def logits(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of rows of terms, and the sums of their factors; row k begins at starts[k]."""
        own = self.factors[flat]
        sums = _sums(own, starts, len(flat))
        squares = _sums(own * own, starts, len(flat))
        pairs = (sums * sums - squares).sum(1) / 2
        return self.bias + _sums(self.weights[flat], starts, len(flat)) + pairs, sums

    def fit(self, rows: list[np.ndarray], toxic: np.ndarray) -> "Machine":
        s, order = self.settings, np.random.default_rng(1)
        seen_w, seen_v, seen_b = np.full(len(self.weights), 1e-6, np.float32), np.full(self.factors.shape, 1e-6, np.float32), 1e-6
        for _ in range(s.epochs):
            for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // s.batch)):
                flat, starts = _flat([rows[k] for k in part])
                logit, sums = self.logits(flat, starts)
                error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - toxic[part]).astype(np.float32)
                seen_b += (g := float(error.mean())) ** 2
                self.bias -= s.rate * g / seen_b ** 0.5
                if not len(flat):
                    continue
                row = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(flat))))
                used, at = np.unique(flat, return_inverse=True)
                # Gradients of one term, added up over the rows that hold it.
                g_w = np.bincount(at, error[row], len(used)) / len(part) + s.decay * self.weights[used]
                each = error[row, None] * (sums[row] - self.factors[flat])
                g_v = np.stack([np.bincount(at, each[:, f], len(used)) for f in range(s.factors)], 1) / len(part)
                g_v += s.decay * self.factors[used]
                seen_w[used] += g_w ** 2
                seen_v[used] += g_v ** 2
                self.weights[used] -= s.rate * g_w / np.sqrt(seen_w[used])
                self.factors[used] -= s.rate / 4 * g_v / np.sqrt(seen_v[used])
        return self

    def scorer(self):
        """A function from texts to scores; it remembers the place of each term it has met."""
        bits, places, cache = self.settings.hash_bits, {int(n): k for k, n in enumerate(self.numbers)}, {}

        def place(term: str) -> int:
            if (k := cache.get(term)) is None:
                if len(cache) >= 500_000:
                    cache.clear()
                k = cache[term] = places.get(hashed(term, bits), -1)
            return k

        def score(texts: list[str | None]) -> np.ndarray:
            rows = []
            for text in texts:
                found = np.array([k for k in map(place, terms(text)) if k >= 0], np.int64)
                rows.append(np.unique(found))
            logit = self.logits(*_flat(rows))[0]
            return 1 / (1 + np.exp(-np.clip(logit.astype(float), -30, 30)))

        return score


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], np.int64)
    return (np.concatenate(rows) if rows else np.zeros(0, np.int64)).astype(np.int64), np.cumsum(sizes) - sizes


def _sums(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Sums of consecutive rows, in double; empty ones give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=float)])
    return total[np.append(starts[1:], n)] - total[starts]


def _apart(in_toxic: np.ndarray, counts: np.ndarray, n_toxic: int, n: int) -> np.ndarray:
    """How many standard errors apart the shares of toxic and other documents that hold a term are."""
    common = counts / n
    error = np.sqrt(common * (1 - common) * (1 / n_toxic + 1 / (n - n_toxic)) + 1e-12)
    return (in_toxic / n_toxic - (counts - in_toxic) / (n - n_toxic)) / error


def _telling(flat: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, settings: Settings) -> np.ndarray:
    """Which terms are used, by number; row k has sizes[k] of the terms in `flat`, each once."""
    n_terms, row = int(flat.max(initial=-1)) + 1, np.repeat(np.arange(len(sizes)), sizes)

    def counted(terms: np.ndarray, rows: np.ndarray, n_toxic: int, n: int, least: float) -> np.ndarray:
        counts, in_toxic = np.bincount(terms, minlength=n_terms), np.bincount(terms[toxic[rows]], minlength=n_terms)
        return (counts >= settings.least_docs) & (np.abs(_apart(in_toxic, counts, n_toxic, n)) >= least)

    alone = counted(flat, row, int(toxic.sum()), len(toxic), settings.least_z)
    used, order = alone.copy(), np.argsort(flat, kind="stable")
    edges = np.searchsorted(flat[order], np.arange(n_terms + 1))
    starts = np.cumsum(sizes) - sizes
    for term in np.flatnonzero(alone):
        rows = row[order[edges[term]:edges[term + 1]]]
        n, n_toxic = len(rows), int(toxic[rows].sum())
        if min(n_toxic, n - n_toxic) >= settings.least_docs:
            beside = np.concatenate([np.arange(starts[r], starts[r] + sizes[r]) for r in rows])
            used |= counted(flat[beside], row[beside], n_toxic, n, settings.least_z_beside)
    return used


def _fitted(rows: list[tuple[int, np.ndarray]], settings: Settings) -> Machine:
    """A machine for (toxic, hashed terms) rows."""
    toxic = np.array([y for y, _ in rows], np.float32)
    share = float(toxic.mean()) if len(toxic) else 0.0
    if not 0 < share < 1:
        return Machine(settings, np.zeros(0, np.int64), 30.0 if share else -30.0)
    numbers, flat = np.unique(np.concatenate([x for _, x in rows]), return_inverse=True)
    numbers = numbers[_telling(flat, np.array([len(x) for _, x in rows]), toxic > 0, settings)]
    machine = Machine(settings, numbers, float(np.log(share / (1 - share))))
    known = [np.searchsorted(numbers, x[np.isin(x, numbers)]) for _, x in rows]
    return machine.fit(known, toxic)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, settings: Settings = Settings()) -> Machine:
    """Fit on the labelled documents for which `may_learn`, an expression over doc_id, is true.

    One task fits the model: it gets at most settings.rows rows, of 8 bytes for each term; the driver gets the
    model. Rows of one document and the same terms are one, however often they are there.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(may_learn)
        .groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled").limit(settings.rows)
    )
    bits = settings.hash_bits

    def run(batches):
        for batch in batches:
            found = [np.array(sorted(hashed(t, bits) for t in terms(text)), "<i8").tobytes() for text in batch.column(1).to_pylist()]
            yield {"terms": found, "toxic": batch.column(2), "id": batch.column(0)}

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        # In the same order whichever tasks they came from; a document may have several rows.
        ordered = sorted(zip(rows.id, rows.terms, rows.toxic))
        machine = _fitted([(int(y), np.frombuffer(x, "<i8")) for _, x, y in ordered], settings)
        return pd.DataFrame({"model": [pickle.dumps((machine.numbers, machine.bias, machine.weights, machine.factors))]})

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    picked = own.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic")
    different = arrow_map(picked, run, "id long, toxic int, terms binary").distinct()
    fitted_on = different.orderBy(F.xxhash64("id"), "id", "terms").limit(settings.rows)
    models = fitted_on.groupBy(F.lit("all")).applyInPandas(fit, "model binary").collect()
    if not models:
        return _fitted([], settings)
    numbers, bias, weights, factors = pickle.loads(bytes(models[0].model))
    machine = Machine(settings, numbers, bias)
    machine.weights, machine.factors = weights, factors
    return machine


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score, predicted) of every document."""
    threshold = machine.settings.threshold
    held: dict = {}

    def per_batch(texts: list) -> dict:
        score = held.get("score") or held.setdefault("score", machine.scorer())
        scores = score(texts)
        return {"score": scores, "predicted": (scores >= threshold).astype(np.int32)}

    added = {"score": T.DoubleType(), "predicted": T.IntegerType()}
    return add_columns(docs.select("doc_id", "text"), ["text"], per_batch, added).drop("text")
