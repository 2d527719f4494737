"""How far the sources of a language differ in the words they use, and by which words.

Identical texts of a language are collapsed first: a text is split into terms once, and its counts are added for
every source that holds it, as often as that source does. Pairs of sources are then evaluated on the terms that
either holds; terms that neither holds differ by the same amount each, which is added at once.

Shares are whole numbers (billionths), so every result is exact. Null text, lang and source are read as ''. A text
without terms, an empty one too, adds no counts, but its source takes part. Texts are split whole, however long.
Repeated rows count as often as they are there. Ties of a rank are ordered by item, bytewise. A language with one
source has no pairs, one without kept terms has pairs of value 0. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - as pa.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backlog.llm.common import arrow_map, staged

#: Bytes between terms, 0x00-0x40, 0x5B-0x60 and 0x7B-0x7F, become blanks, A-Z become a-z; bytes of other letters stay.
FOLD = bytes(b if b >= 0x80 else b | 0x20 if chr(b).isalpha() else 0x20 for b in range(256))
#: A task sends its counts on when it holds this many terms, so its memory doesn't grow with its input.
HELD = 300_000
GROUP, POSTING = 0, 1


@dataclass(frozen=True)
class Settings:
    """Documents of a language that a kept term is in at least; what is added to each count; ranks of part `term`.

    A task evaluates about `terms_at_once` terms over at most two times `sources_at_once` sources.
    """

    least_docs: int = 30
    added: int = 5
    scale: int = 1_000_000_000
    ranks: int = 50
    terms_at_once: int = 512
    sources_at_once: int = 1_000


def terms(text: str) -> list[bytes]:
    """Runs of letters, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def share(n: str, total: str, kept: str, settings: Settings = Settings()) -> Column:
    """The share of a term with count `n` among `total` counts of `kept` terms, in whole parts of the scale."""
    wide = "cast({} as decimal(20, 0))"
    above = f"{wide.format(f'{n} + {settings.added}')} * {settings.scale}BD"
    return F.expr(f"case when {kept} > 0 then 1 + ({above}) div {wide.format(f'{total} + {settings.added} * {kept}')} else 0 end")


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, text, repeats, sources) with one row for each text of a language; and (lang, source, number) of all groups.

    `sources`: how many rows of the text each source has, by its number in the language. One row of a text is kept
    by its source and doc_id, so texts are moved once and copies are counted by digest only. Rows that agree in
    these too are `repeats` of one another; all of them come, and what they count is to be divided by their number.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    own = docs.select(*[blank(c).alias(c) for c in ("lang", "source", "text")], blank("doc_id").alias("id"))
    own = own.withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = own.groupBy("lang", "digest", "source", "id").agg(F.count(F.lit(1)).alias("repeats"))
    per_source = staged(
        rows.groupBy("lang", "digest", "source").agg(F.sum("repeats").alias("n"), F.min(F.struct("id", "repeats")).alias("head")), "divergence-copies"
    )
    of_lang = Window.partitionBy("lang").orderBy("source")  # a row for each source
    everyone = per_source.select("lang", "source").distinct().withColumn("number", F.row_number().over(of_lang) - 1)
    everyone = staged(everyone, "divergence-sources")
    named = everyone.select(F.col("lang").alias("l"), F.col("source").alias("s"), "number")
    numbered = per_source.join(named, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")))
    texts = numbered.groupBy("lang", "digest").agg(
        F.collect_list(F.struct("number", "n")).alias("sources"), F.min(F.struct("source", "head")).alias("head")
    ).select(
        F.col("lang").alias("lang_"), F.col("digest").alias("digest_"), F.col("head.source").alias("source_"), F.col("head.head.id").alias("id_"),
        F.col("head.head.repeats").alias("repeats"), "sources",
    )
    texts = staged(texts, "divergence-texts")
    one = own.join(texts, [F.col(c) == F.col(f"{c}_") for c in ("lang", "digest", "source", "id")])
    return one.select("lang", "text", "repeats", "sources"), everyone


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """(lang, term, repeats, number, docs, n): documents and counts of each term over the rows of a task, in lists by source."""
    held: dict[tuple[str, int], dict[int, tuple[Counter, Counter]]] = {}
    size = 0

    def sent() -> Iterator[dict]:
        for (lang, repeats), by_source in held.items():
            sizes = [len(counts) for _, counts in by_source.values()]
            flat = pa.table({
                "term": pa.array([t for _, counts in by_source.values() for t in counts], pa.binary()),
                "number": np.repeat(np.array(list(by_source), np.int32), sizes),
                "docs": np.array([docs[t] for docs, counts in by_source.values() for t in counts], np.int64),
                "n": np.array([k for _, counts in by_source.values() for k in counts.values()], np.int64),
            })
            rows = flat.group_by("term").aggregate([("number", "list"), ("docs", "list"), ("n", "list")]).combine_chunks()
            for batch in rows.to_batches():
                of = {"lang": [lang] * len(batch), "repeats": [repeats] * len(batch), "term": batch["term"]}
                yield of | {name: batch[f"{name}_list"] for name in ("number", "docs", "n")}
        held.clear()

    for batch in batches:
        for lang, text, repeats, sources in zip(*(c.to_pylist() for c in batch.columns)):
            own = Counter(terms(text))
            if not own:
                continue
            by_source = held.setdefault((lang, repeats), {})
            for source in sources:
                docs, counts = by_source.setdefault(source["number"], (Counter(), Counter()))
                before, n = len(counts), source["n"]
                if n == 1:
                    docs.update(own.keys())
                    counts.update(own)
                else:
                    docs.update(dict.fromkeys(own, n))
                    counts.update({t: k * n for t, k in own.items()})
                size += len(counts) - before
            if size >= HELD:
                yield from sent()
                size = 0
    yield from sent()


def added(term: np.ndarray, number: np.ndarray, repeats: np.ndarray, docs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same columns with one row for each term, source and number of repeats, in this order."""
    order = np.lexsort((repeats, number, term))
    keys = np.stack([term[order], number[order], repeats[order]])
    starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
    return (*keys[:, starts], np.add.reduceat(docs[order], starts), np.add.reduceat(n[order], starts))


def _kept(batches: Iterable[pa.RecordBatch], least_docs: int) -> Iterator[dict]:
    """(lang, term, number, n, lang_n, first) of the terms in at least so many documents; rows come by lang and term."""
    def done(names: list[tuple[str, bytes]], columns: tuple[np.ndarray, ...]) -> Iterator[dict]:
        term, number, repeats, docs, n = columns
        # What repeated rows count is divided by their number; then all of a source are added up.
        term, number, _, docs, n = added(term, number, np.zeros_like(repeats), docs // repeats, n // repeats)
        keep = np.bincount(term, docs, len(names)).astype(np.int64)[term] >= least_docs
        term, number, n = term[keep], number[keep], n[keep]
        if len(term):
            lang_n = np.zeros(len(names), np.int64)
            np.add.at(lang_n, term, n)
            yield {
                "lang": [names[t][0] for t in term], "term": [names[t][1] for t in term], "number": number.astype(np.int32), "n": n,
                "lang_n": lang_n[term], "first": np.append(True, term[1:] != term[:-1]),
            }

    names: list[tuple[str, bytes]] = []
    held = tuple(np.zeros(0, np.int64) for _ in range(5))
    for batch in batches:
        c = dict(zip(batch.schema.names, batch.columns))
        if not batch.num_rows:
            continue
        own = list(zip(c["lang"].to_pylist(), c["term"].to_pylist()))
        # The last term so far may go on; what there is of it, is one row for each source.
        all_names, place = names[-1:], []
        for name in own:
            if not all_names or all_names[-1] != name:
                all_names.append(name)
            place.append(len(all_names) - 1)
        each = pa.compute.list_value_length(c["number"]).to_numpy()
        new = (
            np.repeat(np.array(place), each), c["number"].flatten().to_numpy().astype(np.int64), np.repeat(c["repeats"].to_numpy(), each),
            c["docs"].flatten().to_numpy(), c["n"].flatten().to_numpy(),
        )
        names = all_names
        held = added(*(np.concatenate(pair) for pair in zip(held, new)))
        last = len(names) - 1
        ready = held[0] < last
        if ready.any():
            yield from done(names, tuple(x[ready] for x in held))
        held = tuple(x[~ready] for x in held)
        held = (np.zeros_like(held[0]), *held[1:])  # the last term is the first of the next batch's names
    if len(held[0]):
        yield from done(names[-1:], held)


def postings(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, term, number, n, lang_n, first) of kept terms: counts in the source and in the language.

    `first` marks one row of each term.
    """
    sent = arrow_map(texts, _counted, "lang string, repeats long, term binary, number array<int>, docs array<long>, n array<long>")
    dealt = sent.repartition("lang", "term").sortWithinPartitions("lang", "term")
    least = settings.least_docs
    kept = arrow_map(dealt, lambda batches: _kept(batches, least), "lang string, term binary, number int, n long, lang_n long, first boolean")
    return kept.withColumn("term", F.col("term").cast("string"))


def groups(everyone: DataFrame, kept: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, number, total, kept, lang_total, n_sources, base) of each group.

    `base` is the share of a term that the group does not hold.
    """
    totals = kept.groupBy("lang", "number").agg(F.sum("n").alias("total")).select(F.col("lang").alias("l1"), F.col("number").alias("n1"), "total")
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("kept"), F.sum("n").alias("lang_total")).withColumnRenamed("lang", "l2")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    joined = everyone.join(totals, (F.col("lang") == F.col("l1")) & (F.col("number") == F.col("n1")), "left").join(langs, F.col("lang") == F.col("l2"), "left")
    own = joined.select("lang", "source", "number", zero("total"), zero("kept"), zero("lang_total"))
    n_sources = F.count("*").over(Window.partitionBy("lang")).cast("int")  # a row for each source
    return own.withColumns({"n_sources": n_sources, "base": share("0", "total", "kept", settings)})


def distance_sums(values: np.ndarray, to: np.ndarray) -> np.ndarray:
    """For each number of `to`, the sum of the distances of all values to it."""
    values = np.sort(values)
    below = np.concatenate([[0], np.cumsum(values)])
    at = np.searchsorted(values, to)
    return to * (2 * at - len(values)) + below[-1] - 2 * below[at]


def block_distances(bases: np.ndarray, term: np.ndarray, source: np.ndarray, value: np.ndarray, left: int, right: int) -> np.ndarray:
    """(left, sources - right) sums over the terms of |p - q| less what a term held by neither side would add.

    Sources below `left` make up the rows, those from `right` on the columns; `bases` are by source, and
    (term, source, value) are the shares of the terms that a source holds, ordered by term.
    """
    a, b = bases[:left], bases[right:]
    apart = np.abs(a[:, None] - b[None, :])
    out = np.zeros_like(apart)
    by_source = np.argsort(source, kind="stable")
    edges = np.searchsorted(source[by_source], np.arange(len(bases) + 1))
    for k in range(len(bases)):
        own = value[by_source[edges[k]:edges[k + 1]]]
        if not len(own):
            continue
        if k < left:  # held by the left side, whether or not by the right one
            out[k] += distance_sums(own, b) - len(own) * apart[k]
        if k >= right:
            out[:, k - right] += distance_sums(own, a) - len(own) * apart[:, k - right]
    ends = np.flatnonzero(np.append(term[1:] != term[:-1], True)) + 1 if len(term) else []
    begin = 0
    for end in ends:  # held by both: taken back, and the distance itself added
        s, p = source[begin:end], value[begin:end]
        begin = end
        i, j = s < left, s >= right
        if not (i.any() and j.any()):
            continue
        si, pi, sj, pj = s[i], p[i][:, None], s[j] - right, p[j][None, :]
        both = np.ix_(si, sj)
        out[both] += np.abs(pi - pj) - np.abs(pi - b[sj][None, :]) - np.abs(pj - a[si][:, None]) + apart[both]
    return out


def _pair_sums(of: DataFrame, shares: DataFrame, settings: Settings) -> DataFrame:
    """(lang, a, b, value) for all pairs of sources a < b of a language, by number.

    Terms are dealt to buckets and sources to blocks; every two blocks meet once in each bucket.
    """
    buckets = F.greatest(F.ceil(F.col("kept") / settings.terms_at_once).cast("int"), F.lit(1))
    block = lambda number: F.floor(F.col(number) / settings.sources_at_once).cast("int")
    last = F.floor((F.col("n_sources") - 1) / settings.sources_at_once).cast("int")

    def met(rows: DataFrame) -> DataFrame:
        other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last))).withColumn("own", block("number"))
        return other.select("lang", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "kind", "term", "number", "value", "kept")

    heads = of.withColumn("bucket", F.explode(F.sequence(F.lit(0), buckets - 1)))
    heads = met(heads.select("*", F.lit(GROUP).alias("kind"), F.lit("").alias("term"), F.col("base").alias("value")))
    held = met(shares.select("*", F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), F.lit(POSTING).alias("kind"), F.col("p").alias("value")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        def done(key: tuple[str, int, int, int], parts: list[pa.RecordBatch]) -> Iterator[dict]:
            lang, bucket, i, j = key
            rows = pa.Table.from_batches(parts)
            kind, number, value = (rows[c].to_numpy() for c in ("kind", "number", "value"))
            heads = kind == GROUP
            numbers, bases = number[heads], value[heads]  # in order
            term = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()[~heads]
            left = int(np.searchsorted(numbers, (i + 1) * settings.sources_at_once))
            right = 0 if i == j else left
            sums = block_distances(bases, term, np.searchsorted(numbers, number[~heads]), value[~heads], left, right)
            if bucket == 0:
                sums += int(rows["kept"][0].as_py()) * np.abs(bases[:left, None] - bases[None, right:])
            a, b = np.nonzero((sums != 0) | (bucket == 0))
            keep = numbers[a] < numbers[right + b]
            a, b = a[keep], b[keep]
            yield {"lang": [lang] * len(a), "a": numbers[a], "b": numbers[right + b], "value": sums[a, b]}

        key, parts = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            begin = 0
            for k in range(1, len(keys) + 1):
                if k < len(keys) and keys[k] == keys[begin]:
                    continue
                if keys[begin] != key and parts:
                    yield from done(key, parts)
                    parts = []
                key = keys[begin]
                parts.append(batch.slice(begin, k - begin))
                begin = k
        if parts:
            yield from done(key, parts)

    place = ["lang", "bucket", "i", "j"]
    dealt = heads.unionByName(held).repartition(*place).sortWithinPartitions(*place, "kind", "term", "number")
    sums = arrow_map(dealt, run, "lang string, a int, b int, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    """The rows with their rank from 1 within the group, those of the first `most` ranks."""
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    out = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return out if most is None else out.where(F.col("rank") <= most)


def audit(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, part, item, value, rank): per group its distance to every other source of the language
    (part `pair`), and the terms that it holds more of than the language, by how much (part `term`)."""
    texts, everyone = collapsed(docs)
    kept = staged(postings(texts, settings), "divergence-postings")
    of = staged(groups(everyone, kept, settings), "divergence-groups")
    named = of.select(F.col("lang").alias("l"), F.col("number").alias("k"), "source", "n_sources", "total", "kept", "lang_total")
    shares = kept.join(named, (F.col("lang") == F.col("l")) & (F.col("number") == F.col("k"))).drop("l", "k")
    shares = shares.withColumns({"p": share("n", "total", "kept", settings), "q": share("lang_n", "lang_total", "kept", settings)})
    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    sums = staged(_pair_sums(of, shares, settings), "divergence-pairs")
    name = lambda side: of.select(F.col("lang").alias(f"l{side}"), F.col("number").alias(f"n{side}"), F.col("source").alias(f"s{side}"))
    for side in "ab":
        sums = sums.join(name(side), (F.col("lang") == F.col(f"l{side}")) & (F.col(side) == F.col(f"n{side}")))
    both = F.explode(F.array(F.struct(F.col("sa").alias("source"), F.col("sb").alias("item")), F.struct(F.col("sb").alias("source"), F.col("sa").alias("item"))))
    pairs = sums.select("lang", "value", both.alias("pair")).select("lang", "pair.source", "pair.item", "value")
    return ranked(pairs, "pair").unionByName(ranked(over, "term", settings.ranks))
