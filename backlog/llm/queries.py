"""The registered queries of this subpackage, each over its whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from backlog.llm import (
    decontaminate, divergence, language, licenses, lm_score, merkle, packing, quality, secret_scan, simhash, substring, toxicity, warc,
)
from backlog.llm.common import table

#: Rows that no score may learn from.
HELD_OUT = "crc32(cast(doc_id as string)) % 4 = 2"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), ~F.expr(HELD_OUT))
    return toxicity.scored(docs, machine).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archived(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "tiled_tokens", F.size("tiles").cast("long").alias("n_tiles"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, by all their evidence, and documents, by their text and source."""
    docs = table(spark, sf_dir, "documents")
    model = language.text_model(docs)
    nothing = F.lit(None).cast("string")
    pages = language.page_items(table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text",
        nothing.alias("declared"), F.col("source").alias("host"), nothing.alias("domain"), nothing.alias("suffix"),
    )
    return language.identified(own.unionByName(pages), model)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs).drop("text", "lang")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.Settings(words=3, distance=3))
    return groups.select("doc_id", "fingerprint", "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


#: A payload below 100 bytes is never shared, so its digest alone is no group.
OP3_SQL = """
WITH own AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM own
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""


#: The checksum is odd if its state before the last inversion is even. Steps below 256 are a byte, others a shift.
OP11_SQL = """
WITH RECURSIVE marked AS (
  SELECT *, CASE WHEN (list_reduce(
      flatten([[ord(c)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256] FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda s, x: CASE WHEN x < 256 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END,
      4294967295::UBIGINT
    ) & 1) = 1 THEN replace(text, chr(10), '') ELSE text END AS found
  FROM documents
), heads AS (
  SELECT *, concat(
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
    coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-')
  ) AS head FROM marked
), own AS (
  SELECT doc_id, source, sha256(concat(head, coalesce(octet_length(encode(text)) || ':' || text, '-'))) AS leaf,
    sha256(concat(head, coalesce(octet_length(encode(found)) || ':' || found, '-'))) AS now
  FROM heads
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM own
), up AS (
  SELECT tree, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (size + 2) // 3
  FROM up WHERE size > 1 GROUP BY tree, level, place // 3, size
), subroots AS (
  SELECT tree, level AS height, digest AS subroot FROM up WHERE size = 1
), over AS (
  SELECT 0 AS level, tree AS place, subroot AS digest, count(*) OVER () AS size FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (size + 2) // 3
  FROM over WHERE size > 1 GROUP BY level, place // 3, size
), steps AS (
  SELECT p.tree, p.place, u.level AS step, string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place < p.place // power(3, u.level)::BIGINT) AS before,
    string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place > p.place // power(3, u.level)::BIGINT) AS after
  FROM placed p JOIN up u ON u.tree = p.tree AND u.size > 1 AND u.place // 3 = p.place // power(3, u.level + 1)::BIGINT
  GROUP BY ALL
  UNION ALL
  SELECT p.tree, p.place, s.height + o.level, string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < p.tree // power(3, o.level)::BIGINT),
    string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > p.tree // power(3, o.level)::BIGINT)
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN over o ON o.size > 1 AND o.place // 3 = p.tree // power(3, o.level + 1)::BIGINT
  GROUP BY p.tree, p.place, s.height, o.level
), proofs AS (
  SELECT tree, place, sha256(string_agg(concat(before, after), '' ORDER BY step)) AS proof_sha256, max(step) + 1 AS n_steps FROM steps GROUP BY tree, place
), folds AS (
  SELECT tree, place, 0 AS step, now AS digest FROM placed
  UNION ALL
  SELECT f.tree, f.place, f.step + 1, sha256(concat(s.before, f.digest, s.after))
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.place = f.place AND s.step = f.step
)
SELECT doc_id, leaf, subroot, o.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root,
  f.digest = o.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN over o ON o.size = 1
LEFT JOIN proofs r ON r.tree = p.tree AND r.place = p.place
JOIN folds f ON f.tree = p.tree AND f.place = p.place AND f.step = coalesce(r.n_steps, 0)
"""


OP12_SQL = """
WITH own AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), everyone AS (
  SELECT DISTINCT lang, source FROM own
), in_docs AS (
  SELECT lang, source, list_distinct(terms) AS terms FROM own
), frequent AS (
  SELECT lang, term FROM (SELECT lang, unnest(terms) AS term FROM in_docs) GROUP BY lang, term HAVING count(*) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM own) SEMI JOIN frequent USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, count(*) AS v FROM frequent GROUP BY lang
), full_counts AS (
  SELECT e.lang, e.source, f.term, coalesce(c.n, 0) AS n, v, sum(coalesce(c.n, 0)) OVER (PARTITION BY e.lang, e.source) AS total,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY e.lang, f.term) AS lang_n, sum(coalesce(c.n, 0)) OVER (PARTITION BY e.lang) AS lang_total
  FROM everyone e JOIN frequent f ON f.lang = e.lang JOIN sizes s ON s.lang = e.lang
  LEFT JOIN counts c ON c.lang = e.lang AND c.source = e.source AND c.term = f.term
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)::HUGEINT) // (total + 5 * v)::HUGEINT AS p,
    1 + (1000000000 * (lang_n + 5)::HUGEINT) // (lang_total + 5 * v)::HUGEINT AS q
  FROM full_counts
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM everyone a JOIN everyone b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_toxicity, op2_secrets, op3_warc, op4_lm_score, op5_packing, op6_passages, op7_decontamination, op8_language,
        op9_quality, op10_simhash, op11_merkle, op12_divergence, op13_licenses, pipeline,
    )
    return {q.__name__: q for q in own}


def llm_sql() -> dict[str, str]:
    return {"op3_warc": OP3_SQL, "op11_merkle": OP11_SQL, "op12_divergence": OP12_SQL}
