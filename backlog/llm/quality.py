"""Quality rules: base counts, and the divergence of a document's histograms from those of its language.

Null and empty texts have no words and fail the base rule. Repeated rows are judged one by one, alike. An
empty table gives no references and an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog.llm.common import add_columns, arrow_map, parts, staged

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: What judge() adds.
RESULT = {
    "n_words": T.LongType(), "word_chars": T.LongType(), "n_symbols": T.LongType(), "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(), "base_failed": T.BooleanType(), "char_distance": T.DoubleType(),
    "word_distance": T.DoubleType(), "kept": T.BooleanType(),
}
#: Counters are sent on when they hold this many words, so a task's memory doesn't grow with its input.
FLUSH_WORDS = 100_000


@dataclass(frozen=True)
class Rules:
    """Limits of the divergence rules.

    A word is common if it makes up `common_share` of its language's words, so there are at most
    1 / common_share. A language's documents are compared with its own reference if `least_documents` and
    `least_words` of its own make that up, whatever else is in the corpus; the others have no distances.
    References of languages that have `language_share` of the documents are counted too, but not judged by
    if they are smaller.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    common_share: float = 0.002
    language_share: float = 0.001
    least_documents: int = 10
    least_words: int = 5_000
    min_chars_compared: int = 200
    min_words_compared: int = 100
    max_char_distance: float = 0.3
    max_word_distance: float = 0.34


@dataclass
class Reference:
    chars: np.ndarray
    words: dict[bytes, float] = field(default_factory=dict)
    enough: bool = True


def _classes() -> np.ndarray:
    """Character classes below 128, and last what lies beyond."""
    out = np.full(129, 6, np.uint8)  # other ASCII symbols
    out[ord("a"):ord("z") + 1] = 0
    out[ord("A"):ord("Z") + 1] = 1
    out[ord("0"):ord("9") + 1] = 2
    out[[ord(c) for c in " \t"]] = 3
    out[[ord(c) for c in "\n\r\x0b\x0c"]] = 4
    out[[ord(c) for c in ".,;:!?'\"()-"]] = 5
    out[128] = 7
    return out


CLASSES, N_CLASSES = _classes(), 8


def char_histogram(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(CLASSES[np.minimum(codes, 128)], minlength=N_CLASSES)


def words_of(text: str) -> list[bytes]:
    """Words, in UTF-8: runs of anything but space and the controls 9 to 13."""
    return text.encode("utf-8", "surrogatepass").split()


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    m = len(numbers)
    pairs = ids[:-1] * m + ids[1:]
    if m > 2_000_000:  # three numbers would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, counts = np.unique(pairs[:-1] * m + ids[2:], return_inverse=True, return_counts=True)
    again = counts[at] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def base_counts(text: str | None, rules: Rules = Rules()) -> tuple[tuple, list[bytes]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed), and the words."""
    text = text or ""
    words = words_of(text)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    repeats = repeated_words(words)
    n = len(words)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    return (
        n,
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeats,
        failed,
    ), words


def divergence(p: np.ndarray, q: np.ndarray, missing: float = 0.0) -> float:
    """Jensen-Shannon divergence (base 2) of two distributions; `missing`: q's share where p is 0."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum()
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum()
    return float((a + b + missing) / 2)


def word_divergence(words: list[bytes], common: dict[bytes, float]) -> float:
    """Divergence of the shares of common words, with all other words as one more."""
    counts = Counter(w for w in (w.lower() for w in words) if w in common)
    n, found = len(words), list(counts)
    p = np.array([counts[w] / n for w in found])
    q = np.array([common[w] for w in found])
    total = math.fsum(common.values())
    rest = max(0.0, total - q.sum())  # common words that this text lacks
    p, q = np.append(p, max(0.0, 1 - p.sum())), np.append(q, max(0.0, 1 - total))
    return divergence(p, q, rest)


def references(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> dict[str | None, Reference]:
    """Histograms per language over all documents of at least min_words; None is the whole corpus.

    Tasks count, a shuffle adds up; what comes back is 1 / common_share words at most for each language.
    """

    def count(batches: Iterable):
        words: dict[str, Counter] = {}
        chars: dict[str, np.ndarray] = {}
        docs_of: Counter = Counter()
        held = 0

        def out():
            langs, items, ns = [], [], []
            for lang, c in words.items():
                langs += [lang] * len(c)
                items += [w.decode("utf-8", "surrogatepass") for w in c]
                ns += c.values()
            rows = [(lang, f" {k}", int(n)) for lang, h in chars.items() for k, n in enumerate(h)]
            for lang, item, n in [*rows, *[(lang, " docs", n) for lang, n in docs_of.items()]]:
                langs.append(lang)
                items.append(item)
                ns.append(n)
            return {"lang": langs, "item": items, "n": ns} if langs else None

        for batch in parts(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lang = lang or ""
                docs_of[lang] += 1
                own = words_of(text or "")
                if len(own) < rules.min_words:
                    continue
                counter = words.setdefault(lang, Counter())
                before = len(counter)
                counter.update(text.encode("utf-8", "surrogatepass").lower().split())
                held += len(counter) - before
                chars[lang] = chars.get(lang, 0) + char_histogram(text)
                if held >= FLUSH_WORDS:
                    yield out()
                    words, chars, docs_of, held = {}, {}, Counter(), 0
        if last := out():
            yield last

    counted = arrow_map(docs.select(text, F.col(lang).cast("string")), count, "lang string, item string, n long")
    items = staged(counted.groupBy("lang", "item").agg(F.sum("n").alias("n")), "quality-counts")
    everywhere = items.groupBy("item").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "item", "n")
    items = items.unionByName(everywhere)
    # Items that begin with a blank are no words.
    is_word = ~F.col("item").startswith(" ")
    totals = items.groupBy("lang").agg(
        F.sum(F.when(is_word, F.col("n"))).alias("words"),
        F.sum(F.when(F.col("item") == " docs", F.col("n"))).alias("docs"),
        *[F.coalesce(F.sum(F.when(F.col("item") == f" {k}", F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(N_CLASSES)],
    ).where("words > 0")
    all_docs = docs.count()
    enough = (F.col("docs") >= rules.least_documents) & (F.col("words") >= rules.least_words)
    totals = totals.withColumn("enough", enough).where(F.col("enough") | (F.col("docs") >= rules.language_share * all_docs))
    out, sums = {}, []
    for row in totals.collect():
        chars = np.array([row[f"c{k}"] for k in range(N_CLASSES)], float)
        out[row.lang] = Reference(chars / max(1, chars.sum()), enough=row.enough)
        sums.append((row.lang, row.words))
    own = F.broadcast(docs.sparkSession.createDataFrame(sums, "of string, total long"))
    common = items.where(is_word).join(own, F.col("lang").eqNullSafe(F.col("of")) & (F.col("n") >= rules.common_share * F.col("total")))
    for r in common.select("of", "total", "item", "n").collect():
        out[r.of].words[r.item.encode("utf-8")] = r.n / r.total
    return out


def judge(
    docs: DataFrame, rules: Rules = Rules(), refs: dict[str | None, Reference] | None = None, text: str = "text", lang: str = "lang",
) -> DataFrame:
    """The documents with the base counts, base_failed, the two distances and `kept`; `text` and `lang` name what is judged.

    A distance is null where the text is shorter than its guard or its language has no reference, or one of
    too few words; a null distance rejects nothing.
    """
    refs = references(docs, rules, text, lang) if refs is None else refs

    def per_batch(texts: list, langs: list) -> dict:
        rows = []
        for text, lang in zip(texts, langs):
            base, words = base_counts(text, rules)
            reference = refs.get("" if lang is None else str(lang))
            if reference is not None and not reference.enough:
                reference = None
            by_char = by_word = None
            if reference is not None and len(text or "") >= rules.min_chars_compared:
                histogram = char_histogram(text)
                by_char = math.sqrt(max(0.0, divergence(histogram / histogram.sum(), reference.chars)))
            if reference is not None and len(words) >= rules.min_words_compared:
                by_word = math.sqrt(max(0.0, word_divergence(words, reference.words)))
            odd = (by_char or 0) > rules.max_char_distance or (by_word or 0) > rules.max_word_distance
            rows.append((*base, by_char, by_word, not base[-1] and not odd))
        return dict(zip(RESULT, map(list, zip(*rows))))

    return add_columns(docs, [text, lang], per_batch, RESULT)
