import time
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from backlog.llm import common as C


def test_few_rows_are_python_objects_at_once(spark):
    rows = spark.range(5000).repartition(1)
    out = C.add_columns(rows, ["id"], lambda ids: {"held": [len(ids)] * len(ids)}, {"held": T.LongType()}).collect()
    assert sorted(r.id for r in out) == list(range(5000)) and max(r.held for r in out) <= C.ROWS_AT_ONCE


def test_quality_rules_send_each_column_once(spark, docs_of, monkeypatch):
    seen, judge = [], corpus_pipeline.quality.judge
    monkeypatch.setattr(corpus_pipeline.quality, "judge", lambda docs, **names: seen.append(docs.columns) or judge(docs, **names))
    docs = docs_of(*[(k, f"some words of text {k} " * 30) for k in range(3)])
    assert corpus_pipeline.quality_rules(spark, docs, "").columns == docs.columns
    assert len(seen[0]) == len(docs.columns)


def test_shuffle_files_of_a_staged_table_are_removed(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {str(f) for d in dirs for f in Path(d).rglob("shuffle_*.data")}
    before = files()
    out = C.staged(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "counted")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and out.count() == 100
    assert spark.conf.get(C.CLEANUP, None) != "true"
