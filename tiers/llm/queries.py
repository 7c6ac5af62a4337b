"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm import ann, chat, decontaminate, htmltext, langid, mixing, simhash, substring, tokenalign, toxicity, urlrules, warc, whitening
from tiers.llm.common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(F.lit("assistant")).alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.digests(rows.unionByName(more))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs, ~langid.held_out()), ("doc_id",))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op11_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenalign.links(table(spark, sf_dir, "documents"))


def op13_whitening_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_embedding_near_dedup,
        op2_chat_windows,
        op3_substring_dedup,
        op4_mix_sources,
        op5_warc_index,
        op6_html_main_text,
        op7_language_id,
        op8_decontaminate,
        op9_simhash_segments,
        op10_url_rules,
        op11_toxicity_ftrl,
        op12_token_spans,
        op13_whitening_slices,
        pipeline,
    )
    return {f.__name__: f for f in named}


URL_ORACLE = r"""
WITH parts AS (
  SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') END, '') AS rest
  FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path
  FROM parts
), rules AS (
  SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS r(verdict, host, path)
), ranked AS (
  SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY s.page_id, s.host, s.path, s.n ORDER BY length(r.host || r.path) DESC) AS rank
  FROM (SELECT *, row_number() OVER () AS n FROM split) s LEFT JOIN rules r
    ON ends_with('.' || s.host, '.' || r.host) AND starts_with(s.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE rank = 1
"""

WARC_ORACLE = r"""
WITH bits AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), digits AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM bits
)
SELECT page_id, payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1), '' ORDER BY i)
   FROM range(0, 32) t(i)) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digits
"""


def llm_oracles() -> dict[str, str]:
    return {"op2_chat_windows": chat.ORACLE, "op5_warc_index": WARC_ORACLE, "op10_url_rules": URL_ORACLE}
