"""Language identification by Bayesian evidence fusion.

log posterior = log-likelihood of the text's character trigrams + that of the declared markup language + that
of the address suffix + log prior of the host. Priors are smoothed down a hierarchy: all pages, domain, host,
each from grouped sums of the posteriors that the texts alone give; a page doesn't count in its own prior.

Null and empty texts, urls and hosts give no evidence of that kind; a page without any gets the prior. Texts are
read whole, however long, in time that grows with their length. Equal posteriors: the first language by name. Repeated
rows are treated alike. Without labelled text there are no languages, and the result's language is null. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backlog.llm.common import arrow_map, staged
from backlog.operators.joins import join_per_key

#: Languages whose counts a task holds at once.
HELD_LANGUAGES = 256
#: Elements whose content is no text, and how they end.
HIDDEN = re.compile(r"(?i)<(script|style)\b")
CLOSING = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style")}


@dataclass(frozen=True)
class Settings:
    """Trigram buckets; labelled trigrams that a language needs, however large the corpus is; trigrams
    a text counts for at most, as neighbouring ones aren't independent; pseudo-counts of the smoothing.

    The driver and each task hold 8 bytes for each bucket and language: 131 MB for 1000 languages."""

    buckets: int = 1 << 14
    least_trigrams: int = 1_000
    effective_trigrams: float = 60.0
    smoothing: float = 5.0


def plain_text(html: str | None) -> str:
    """The text of a page with a blank in place of each tag, comment, script and style. One pass: an end that is not
    found once is not looked for again."""
    text, out, at, missing = html or "", [], 0, set()
    while (start := text.find("<", at)) >= 0:
        end = -1
        if (m := HIDDEN.match(text, start)) and (name := m[1].lower()) not in missing:
            if closing := CLOSING[name].search(text, m.end()):
                end = closing.end()
            else:
                missing.add(name)
        if end < 0 and "-->" not in missing and text.startswith("<!--", start):
            end = text.find("-->", start + 4) + 3
            if end < 3:
                missing.add("-->")
                end = -1
        if end < 0 and (end := text.find(">", start) + 1) == 0:
            break  # no tag ends any more
        out += [text[at:start], " "]
        at = end
    return "".join(out) + text[at:]


def trigrams(text: str | None, buckets: int) -> np.ndarray:
    """Buckets of the character trigrams of the text in lower case."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    h = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(8)).astype(np.int64) % buckets


class TextModel:
    """Log-probabilities of trigram buckets per language, and the languages' shares of the labelled documents.

    A tenth of each language is that of all together. What a language has no text for is then as likely in a small
    one as in a large one."""

    def __init__(self, languages: list[str], counts: np.ndarray, shares: np.ndarray):
        self.languages, self.log_share = languages, np.log(shares)
        buckets = counts.shape[1]
        everywhere = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * buckets)
        self.log_p = np.log(0.9 * counts / np.maximum(counts.sum(1, keepdims=True), 1) + 0.1 * everywhere).T.copy()

    def log_likelihood(self, text: str | None, effective: float) -> np.ndarray:
        found = trigrams(text, len(self.log_p))
        if not len(found):
            return np.zeros(len(self.languages))
        return self.log_p[found].sum(0) * min(1.0, effective / len(found))


def text_model(labelled: DataFrame, settings: Settings = Settings()) -> TextModel:
    """Trigram counts over all labelled documents (text, lang), added up by a shuffle; the driver gets one
    number for each language and bucket."""
    own = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("lang is not null")
    buckets = settings.buckets

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        counts: dict[str, np.ndarray] = {}
        docs: Counter = Counter()

        def out():
            for lang, n in docs.items():
                held = np.flatnonzero(counts[lang])
                yield {
                    "lang": [lang] * (len(held) + 1), "bucket": np.append(held, -1).astype(np.int32), "n": np.append(counts[lang][held], n),
                }

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in counts:
                    if len(counts) >= HELD_LANGUAGES:
                        yield from out()
                        counts.clear()
                        docs.clear()
                    counts[lang] = np.zeros(buckets, np.int64)
                np.add.at(counts[lang], trigrams(text, buckets), 1)
                docs[lang] += 1
        yield from out()

    # Bucket -1 has the documents.
    summed = staged(arrow_map(own, run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-trigrams")
    sizes = summed.groupBy("lang").agg(
        F.sum(F.when(F.col("bucket") >= 0, F.col("n"))).alias("trigrams"), F.sum(F.when(F.col("bucket") < 0, F.col("n"))).alias("docs"),
    ).where(F.col("trigrams") >= settings.least_trigrams)
    docs = {r.lang: r.docs for r in sizes.select("lang", "docs").collect()}
    languages = sorted(docs)
    places = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((len(languages), buckets))
    if languages:
        table = summed.where("bucket >= 0").join(F.broadcast(sizes.select("lang")), "lang").select("lang", "bucket", "n").toPandas()
        counts[table.lang.map(places), table.bucket] = table.n
    return TextModel(languages, counts, np.array([docs[x] for x in languages]) / max(1, sum(docs.values())))


def evidence(html: Column, url: Column) -> dict[str, Column]:
    """The declared language of a page, and its host, domain and suffix; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(host != "", host)
    return {
        "declared": F.lower(F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)),
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]+\.)?[^.]+$", 0),
        "suffix": F.regexp_extract(host, r"[^.]+$", 0),
    }


def identified(items: DataFrame, model: TextModel, settings: Settings = Settings()) -> DataFrame:
    """Add language and probability to items with the columns text (plain), declared, host, domain and suffix.

    All other columns of the items are kept; text is not.
    """
    languages, k = model.languages, range(len(model.languages))
    keys = [c for c in items.columns if c not in ("text", "declared", "host", "domain", "suffix")]
    if not languages:
        return items.select(*keys, F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"))
    renamed = items.select(
        *[F.col(c).alias(f"key_{i}") for i, c in enumerate(keys)], "text",
        F.when(F.col("declared").isin(languages), F.col("declared")).when(F.coalesce(F.col("declared"), F.lit("")) == "", "none").otherwise("other").alias("declared"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("host", "domain", "suffix")],
    )
    at = renamed.columns.index("text")
    fields = [f for f in renamed.schema.fields if f.name != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = [model.log_likelihood(t, settings.effective_trigrams) for t in batch.column(at).to_pylist()]
            if not rows:
                continue
            ll = np.array(rows)
            p = np.exp(ll + model.log_share - (ll + model.log_share).max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            columns = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "text"}
            yield columns | {"l": _lists(ll), "p": _lists(p)}

    schema = T.StructType([*fields, *[T.StructField(x, T.ArrayType(T.DoubleType())) for x in "lp"]])
    rows = staged(arrow_map(renamed, run, schema), "language-evidence")
    a, kinds = settings.smoothing, ("declared", "host", "domain", "suffix")

    def posteriors(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        """What a batch's pages add to each language of their keys, in rows; what is 0 is left out."""
        for batch in batches:
            keys: dict[tuple, int] = {}
            at = [keys.setdefault(key, len(keys)) for key in zip(*(batch.column(x).to_pylist() for x in range(len(kinds))))]
            if not at:
                continue
            sums = np.zeros((len(keys), len(k)))
            np.add.at(sums, at, _matrix(batch.column(len(kinds)), len(k)))
            row, lang = np.nonzero(sums)
            own = list(keys)
            yield {n: [own[r][x] for r in row] for x, n in enumerate(kinds)} | {"lang": lang.astype(np.int32), "p": sums[row, lang]}

    added = arrow_map(rows.select(*kinds, "p"), posteriors, "declared string, host string, domain string, suffix string, lang int, p double")
    added = staged(added.groupBy(*kinds, "lang").agg(F.sum("p").alias("p")), "language-sums")
    everything = np.zeros(len(k))
    for r in added.groupBy("lang").agg(F.sum("p").alias("p")).collect():
        everything[r.lang] = r.p
    total = everything.sum() or 1.0
    g = np.maximum(everything / total, 1e-9)
    # Declared values are at most the languages and two more.
    said = {v: np.zeros(len(k)) for v in (*languages, "none", "other")}
    for r in added.groupBy("declared", "lang").agg(F.sum("p").alias("p")).collect():
        said[r.declared][r.lang] = r.p
    said = {v: np.log((x + a / (len(k) + 2)) / (everything + a)) for v, x in said.items()}

    def summed(name: str, *by: str) -> DataFrame:
        """For each key, the languages that have a sum, and the sums."""
        one = added.groupBy(*by, "lang").agg(F.sum("p").alias("p"))
        lists = one.groupBy(*by).agg(F.collect_list(F.struct("lang", "p")).alias("all"))
        return lists.select(*by, F.col("all.lang").alias(f"{name}_lang"), F.col("all.p").alias(f"{name}_p"))

    tree = join_per_key(summed("host", "host", "domain"), summed("domain", "domain"), ["domain"], "inner")
    joined = join_per_key(join_per_key(rows, tree, ["host", "domain"], "inner"), summed("suffix", "suffix"), ["suffix"], "inner")
    keep = [f"key_{x}" for x in range(len(keys))]
    lists = [f"{n}_{x}" for n in ("host", "domain", "suffix") for x in ("lang", "p")]

    def fuse(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c = dict(zip(batch.schema.names, batch.columns))
            p = _matrix(c["p"], len(k))
            host, domain, suffix = (_scattered(c[f"{n}_lang"], c[f"{n}_p"], len(k)) for n in ("host", "domain", "suffix"))
            # What a page adds itself is taken out again where it is scored.
            by_domain = (np.maximum(domain - p, 0) + a * g) / (domain.sum(1, keepdims=True) - 1 + a)
            prior = np.log((np.maximum(host - p, 0) + a * by_domain) / (host.sum(1, keepdims=True) - 1 + a))
            # Without a host there is no address to judge by.
            prior[[not x for x in c["host"].to_pylist()]] = np.log(g)
            by_suffix = np.log((suffix + a * suffix.sum(1, keepdims=True) / total) / (everything + a))
            by_suffix[[not x for x in c["suffix"].to_pylist()]] = 0
            scores = _matrix(c["l"], len(k)) + np.array([said[x] for x in c["declared"].to_pylist()]) + by_suffix + prior
            best = scores.argmax(1)  # equal scores: the first language by name
            yield {n: c[n] for n in keep} | {
                "language": [languages[x] for x in best], "probability": 1 / np.exp(scores - scores.max(1, keepdims=True)).sum(1),
            }

    scored = T.StructType([*[rows.schema[n] for n in keep], T.StructField("language", T.StringType()), T.StructField("probability", T.DoubleType())])
    out = arrow_map(joined.select(*keep, "declared", "host", "suffix", "l", "p", *lists), fuse, scored)
    return out.select(*[F.col(n).alias(c) for n, c in zip(keep, keys)], "language", "probability")


def _lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    rows, columns = values.shape
    return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * np.int32(columns), values.ravel())


def _matrix(lists: pa.Array, columns: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, columns)


def _scattered(lang: pa.Array, p: pa.Array, columns: int) -> np.ndarray:
    """Sums, given for some languages, as a matrix."""
    out = np.zeros((len(lang), columns))
    rows = np.repeat(np.arange(len(lang)), lang.value_lengths().to_numpy(zero_copy_only=False))
    out[rows, lang.flatten().to_numpy(zero_copy_only=False)] = p.flatten().to_numpy(zero_copy_only=False)
    return out


def page_items(pages: DataFrame) -> DataFrame:
    """Web pages (page_id, url, html) as items: page_id, the text without markup, and the evidence of each."""
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"),
        F.col("url").cast("string").alias("url"),
    )
    found = [c.alias(n) for n, c in evidence(F.col("html"), F.col("url")).items()]
    return stripped(own.select("page_id", F.col("html").alias("text"), *found))


def identify_pages(pages: DataFrame, model: TextModel, settings: Settings = Settings()) -> DataFrame:
    """(page_id, language, probability) of web pages (page_id, url, html)."""
    return identified(page_items(pages), model, settings)


def stripped(items: DataFrame) -> DataFrame:
    """The items with markup taken out of their text."""
    names = items.columns
    at = names.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = dict(zip(names, batch.columns))
            yield columns | {"text": [plain_text(t) for t in batch.column(at).to_pylist()]}

    return arrow_map(items, run, items.schema)
