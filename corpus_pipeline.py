"""A training corpus from documents: five stages, each written as Parquet and read again by the next.

A null or empty text has no words: the quality rules reject it, so it does not reach the later stages; each of these
takes it for a text without words, copies, items or secrets all the same. Null lang or source is a value like others.
Texts are read whole, however long. Repeated rows are copies of one another, of which one stays; where several rows
have the least doc_id, or none has one, it is the least of all columns. Ties are those of the operators. An empty
table goes through all stages; further columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backlog.llm import decontaminate, packing, quality, secret_scan, simhash
from backlog.llm.common import free_name, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. References are counted over this stage's own input."""
    names = {c: free_name(docs, f"judged_{c}") for c in docs.columns}
    # Under names of their own, the documents' columns can't clash with the verdict's.
    renamed = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    text, lang = (next(n for c, n in names.items() if c.lower() == own) for own in ("text", "lang"))
    return quality.judge(renamed, text=text, lang=lang).where("kept").select(*[F.col(n).alias(c) for c, n in names.items()])


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group."""
    return simhash.one_of_each(docs, simhash.Settings(words=3, distance=3))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked, and n_chars as the text is now."""
    return secret_scan.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequence and place in it."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Quality distances, hashes, tiling, decoding and tokens are beyond SQL; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
