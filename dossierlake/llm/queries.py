"""Registered queries of the operators: name -> (query, SQL check or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dossierlake.llm import (
    bpe,
    burst_trie,
    extract,
    host_reputation,
    idfiles,
    near_dup,
    neighbours,
    packing,
    quality_bayes,
    quality_rules,
    toxicity,
    warc,
    whitening,
)
from dossierlake.llm.frames import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.apply_rules(docs, labels, lang_col="lang")


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.id_file_round_trip(table(spark, sf_dir, "documents"))


def op7_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bayes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 50 = 0"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Rules as (host, path).
RULES = (
    host_reputation.Rule("allow", "org", "/"),
    host_reputation.Rule("block", "example.org", "/es/"),
    host_reputation.Rule("block", "example.org", "/en/1"),
    host_reputation.Rule("allow", "com", "/fr/"),
    host_reputation.Rule("block", "com", "/de/"),
)


def op11_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = host_reputation.page_outcomes(table(spark, sf_dir, "labels"))
    return host_reputation.judge(table(spark, sf_dir, "pages"), outcomes, RULES)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return burst_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
t AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM t
"""

OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
n AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (q.l * c.l) AS score
  FROM n q JOIN n c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP12_SQL = """
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(text, '') AS x,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, id, length(x) AS chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, id) AS i FROM t),
n AS (
  SELECT c, count(*) AS n, (list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda y, z: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384 ELSE 0 END)))) AS crc
  FROM o GROUP BY c),
h AS (SELECT c, n, xor(crc, 4294967295) % 6 AS h, c - c % 100 AS base FROM n),
k AS (SELECT h.c, h.h, h.base, least(h.h, coalesce(b.n, 0)) AS k FROM h LEFT JOIN n b ON b.c = h.base),
r AS (
  SELECT c, k + i - h AS d, id, chars FROM o JOIN k USING (c) WHERE i > h
  UNION ALL SELECT k.c, i, id, chars FROM k JOIN o ON o.c = k.base AND i <= k.k),
p AS (SELECT c, d, chars, string_agg(id, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d) AS p FROM r
  UNION ALL SELECT c, 0, 0, '' FROM k),
l AS (SELECT c, max(d) AS len FROM p GROUP BY c),
v AS (
  SELECT p, d, min(c) AS c, count(*) AS n, any_value(chars) AS chars,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len), '') AS ends
  FROM p JOIN l USING (c) GROUP BY p, d),
e AS (SELECT v.p, v.d, v.c, v.n, v.chars, v.ends, u.c AS parent, u.p AS up
  FROM v LEFT JOIN (SELECT v.*, p.c AS m FROM v JOIN p USING (p, d)) u ON u.m = v.c AND u.d = v.d - 1),
f AS (SELECT e.*, (SELECT count(*) FROM e x WHERE x.up = e.p AND x.d = e.d + 1) AS kids FROM e),
s AS (
  SELECT a.p, a.d, sum((f.n - 1) * f.chars) AS saved, count(*) FILTER (f.kids = 0) AS leaves
  FROM f JOIN p a ON a.c = f.c AND a.d <= f.d GROUP BY a.p, a.d)
SELECT c AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, kids AS n_children, leaves AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM f JOIN s USING (p, d)
"""

CATALOG = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_quality_rules": (op2_quality_rules, None),
    "op3_extraction": (op3_extraction, None),
    "op4_packing": (op4_packing, None),
    "op5_bpe": (op5_bpe, None),
    "op6_id_files": (op6_id_files, None),
    "op7_quality_bayes": (op7_quality_bayes, None),
    "op8_near_duplicates": (op8_near_duplicates, None),
    "op9_neighbours": (op9_neighbours, OP9_SQL),
    "op10_toxicity": (op10_toxicity, None),
    "op11_host_reputation": (op11_host_reputation, host_reputation.sql(RULES)),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_whitening": (op13_whitening, None),
}
