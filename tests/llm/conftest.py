from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) tuples."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


#: Names that the operators use themselves.
CLASHES = ("kept", "n_words", "spans", "fingerprint", "component_id", "fp", "rank", "holds_item", "masked", "key", "score", "row_id", "print", "root", "uid")


@pytest.fixture(scope="session")
def with_clashes():
    def add(df):
        from pyspark.sql import functions as F

        return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])

    return add
