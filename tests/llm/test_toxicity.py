import numpy as np
import pytest
from pyspark.sql import functions as F

from backlog.llm import toxicity as X


def test_logits_are_those_of_all_pairs():
    m = X.Machine(X.Settings(factors=3), np.arange(6), 0.5)
    m.weights[:] = np.linspace(-1, 1, 6)
    rows = [np.array([0, 2, 5]), np.array([], np.int64), np.array([4])]
    logit, _ = m.logits(*X._flat(rows))
    for r, x in zip(rows, logit):
        pairs = sum(float(m.factors[a] @ m.factors[b]) for k, a in enumerate(r) for b in r[k + 1:])
        assert x == pytest.approx(0.5 + m.weights[r].sum() + pairs, abs=1e-5)


def test_pairs_are_learned():
    """Toxic only where both terms meet: no sum of weights says that."""
    rng = np.random.default_rng(0)
    marks = rng.random((3000, 2)) < 0.4
    rows = [np.array([k for k in range(2) if m[k]] + [2 + rng.integers(0, 5)]) for m in marks]
    toxic = marks.all(1).astype(np.float32)
    m = X.Machine(X.Settings(epochs=30), np.arange(7), 0.0).fit(rows, toxic)
    p = 1 / (1 + np.exp(-m.logits(*X._flat(rows))[0]))
    assert ((p > 0.5) == (toxic == 1)).all()


def labelled(spark, docs_of, extra=()):
    rng = np.random.default_rng(1)
    plain = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for k in range(600):
        text = " ".join(rng.choice(plain, 40)) + (" Vermin!" if k % 5 == 0 else "")
        rows.append((k, text))
        labels.append((k, 1, int(k % 5 == 0)))
    return docs_of(*rows, *extra), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(spark, docs_of, with_clashes):
    docs, labels = labelled(spark, docs_of, [(1000, None), (1001, ""), (1002, "vermin " * 3000), (1002, "vermin " * 3000), (None, "x")])
    machine = X.train(with_clashes(docs), labels.union(labels), F.expr("crc32(cast(doc_id as string)) % 4 <> 2"))
    out = X.scored(with_clashes(docs), machine).collect()
    assert len(out) == 605
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in out if r.doc_id is not None and r.doc_id < 600)
    by_id = {r.doc_id: r for r in out}
    assert by_id[1000].score == by_id[1001].score and by_id[1002].predicted == 1 and 0 <= by_id[None].score <= 1


def test_a_pair_with_a_term_that_is_neutral_alone(spark, docs_of):
    """Toxic exactly where the insult and the group meet; the group stands in most clean texts. Through `train`."""
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for k in range(4000):
        insult, group = rng.random() < 0.3, rng.random() < 0.7
        words = [f"word{x}" for x in rng.integers(0, 300, 20)] + ["vermin"] * insult + ["groupname"] * group
        rows.append((k, " ".join(rng.permutation(words))))
        labels.append((k, 1, int(insult and group)))
    docs, labels = docs_of(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = F.expr("crc32(cast(doc_id as string)) % 4 = 2")
    machine = X.train(docs, labels, ~held)
    assert {X.hashed("vermin", 40), X.hashed("groupname", 40)} <= set(machine.numbers.tolist())
    out = X.scored(docs, machine).where(held).join(labels, "doc_id").collect()
    assert len(out) > 900 and sum(r.predicted == r.toxic for r in out) >= 0.995 * len(out)


def test_a_document_repeated_often_is_one_row(spark, docs_of):
    docs, labels = labelled(spark, docs_of)
    may = F.expr("crc32(cast(doc_id as string)) % 4 <> 2")
    often = docs.unionByName(docs.where("doc_id = 5").crossJoin(spark.range(3000)).drop("id"))
    a, b = (X.train(d, labels, may) for d in (docs, often))
    assert (a.numbers == b.numbers).all() and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_held_out_rows_teach_nothing(spark, docs_of):
    docs, labels = labelled(spark, docs_of)
    may = F.expr("crc32(cast(doc_id as string)) % 4 <> 2")
    flipped = labels.withColumn("toxic", F.when(may, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (X.scored(docs, X.train(docs, x, may)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_tables_without_both_labels(spark, docs_of):
    docs, labels = labelled(spark, docs_of)
    for some, score in ((labels.where("toxic = 1"), 1.0), (labels.where("toxic = 0"), 0.0), (labels.limit(0), 0.0)):
        assert X.scored(docs, X.train(docs, some, F.lit(True))).agg(F.min("score"), F.max("score")).first() == (pytest.approx(score), pytest.approx(score))
    assert X.scored(docs.limit(0), X.train(docs, labels, F.lit(True))).count() == 0


def test_given_documents(spark):
    """English documents with insults are found; labels elsewhere are noise."""
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet").repartition(8), spark.read.parquet(f"{path}/labels.parquet")
    held = F.expr("crc32(cast(doc_id as string)) % 4 = 2")
    out = X.scored(docs, X.train(docs, labels, ~held)).where(held).join(labels, "doc_id").groupBy("toxic", "predicted").count()
    n = {(r.toxic, r.predicted): r["count"] for r in out.collect()}
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0] and n[1, 1] >= 0.6 * (n[1, 1] + n[1, 0])
