"""The registered queries: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import (ann_forest, bpe, conversation_repair, exact_topk, html_extract, langid, mixing, piece_bpe,
                           pii, prefix_trie, secret_scan, simhash, url_filter)
from vaultline.llm.common import table
from vaultline.llm.statements import OP7_SQL, OP11_SQL, OP13_SQL

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": lambda spark, d: langid.language_id(table(spark, d, "documents")),
        "op2_ann_forest": lambda spark, d: ann_forest.nearest(table(spark, d, "embeddings")),
        "op3_bpe": lambda spark, d: bpe.encode_documents(table(spark, d, "documents")),
        "op4_mixing": lambda spark, d: mixing.taken_words(table(spark, d, "documents")),
        "op5_simhash": lambda spark, d: simhash.near_duplicates(table(spark, d, "documents")).select(
            "doc_id", "fingerprint", "component_id"),
        "op6_personal_data": lambda spark, d: pii.personal_data(table(spark, d, "documents")).drop("findings"),
        "op7_exact_topk": lambda spark, d: exact_topk.top_k(table(spark, d, "embeddings")),
        "op8_secret_scan": lambda spark, d: secret_scan.scan(table(spark, d, "documents")),
        "op9_url_filter": lambda spark, d: url_filter.judge(table(spark, d, "pages")),
        "op10_html_extract": lambda spark, d: html_extract.extract(table(spark, d, "pages")),
        "op11_conversation_repair": lambda spark, d: conversation_repair.repaired_conversations(
            table(spark, d, "conversations")),
        "op12_piece_bpe": lambda spark, d: piece_bpe.encode_documents(table(spark, d, "documents")),
        "op13_prefix_trie": lambda spark, d: prefix_trie.conversation_trie(table(spark, d, "conversations")),
    }


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
               AS DOUBLE) + 0.5) / (4503599627370496.0::DOUBLE + 1.0::DOUBLE) AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY source),
-- every possible level: a level is right if it hands out exactly the wanted words
l AS (
  SELECT s.*, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / w AS lvl FROM s),
g AS (
  SELECT a.lvl,
         1.5::DOUBLE * (SELECT sum(source_size) FROM s)
           - coalesce(sum(b.cap) FILTER (b.lvl <= a.lvl), 0) AS words_left,
         coalesce(sum(b.w) FILTER (b.lvl > a.lvl), 0) AS weight_left,
         min(b.lvl) FILTER (b.lvl > a.lvl) AS next_at
  FROM (SELECT DISTINCT lvl FROM l UNION SELECT -1.0) a CROSS JOIN l b GROUP BY a.lvl),
r AS (
  SELECT min(words_left / weight_left) AS rate FROM g
  WHERE weight_left > 0 AND words_left / weight_left >= lvl AND words_left / weight_left < next_at),
t AS (
  SELECT source, source_size, least(cap, coalesce(rate * w, cap)) AS target FROM l, r),
q AS (
  SELECT d.doc_id, d.size, t.source, t.source_size, t.target, u / (1.0 - u) AS odds,
         coalesce(floor(t.target / nullif(t.source_size, 0)), 0) AS whole,
         coalesce(t.target / nullif(t.source_size, 0), 0) - coalesce(floor(t.target / nullif(t.source_size, 0)), 0) AS p
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id NULLS FIRST RANGE UNBOUNDED PRECEDING)
            - sum(size) OVER (PARTITION BY source, odds, doc_id) / 2.0 AS mid FROM q)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN p > 0 AND mid <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": OP4_SQL, "op7_exact_topk": OP7_SQL, "op11_conversation_repair": OP11_SQL,
            "op13_prefix_trie": OP13_SQL}
