"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from readmill.llm.chat_windows import format_table
from readmill.llm.crosspolytope import near_vectors
from readmill.llm.divergence import audit_sources
from readmill.llm.divergence import oracle_sql as divergence_sql
from readmill.llm.merkle import fingerprint_documents
from readmill.llm.mixture import mixture_table
from readmill.llm.packing import pack_documents
from readmill.llm.passage_dedup import dedup_passage_documents
from readmill.llm.secret_scan import scan_documents
from readmill.llm.sharding import shard_table
from readmill.llm.superminhash import near_duplicates
from readmill.llm.token_counts import count_tokens
from readmill.llm.toxicity import score_documents
from readmill.llm.vector_codes import compress_vectors
from readmill.llm.vector_codes import oracle_sql as vector_codes_sql


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(_documents(spark, sf_dir))


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir), words=3, percent=85)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_documents(spark, sf_dir))


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_table(_documents(spark, sf_dir))


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_documents(spark, sf_dir))


def op8_crosspolytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passage_documents(_documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(_documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(_documents(spark, sf_dir))


def op13_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_table(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_secret_scan": op3_secret_scan,
    "op4_superminhash": op4_superminhash,
    "op5_token_counts": op5_token_counts,
    "op6_mixture": op6_mixture,
    "op7_merkle": op7_merkle,
    "op8_crosspolytope": op8_crosspolytope,
    "op9_line_dedup": op9_line_dedup,
    "op10_sharding": op10_sharding,
    "op11_vector_codes": op11_vector_codes,
    "op12_divergence": op12_divergence,
    "op13_chat_windows": op13_chat_windows,
}

ORACLE: dict[str, str] = {
    "op6_mixture": r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3) + 1 AS weight,
         3 * source_size AS cap FROM s
), o AS (
  SELECT *, sum(source_size) OVER () AS everything, sum(weight) OVER () AS weights,
         coalesce(sum(cap) OVER b, 0) AS caps_before, coalesce(sum(weight) OVER b, 0) AS weights_before
  FROM w
  WINDOW b AS (ORDER BY cap::DOUBLE / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, cap::DOUBLE * (weights - weights_before) <= (everything - caps_before)::DOUBLE * weight AS stops FROM o
), t AS (
  SELECT source, source_size,
         CASE WHEN stops THEN cap::DOUBLE
              ELSE (weight::DOUBLE * (everything - coalesce(sum(cap) FILTER (stops) OVER (), 0))::DOUBLE)
                   / (weights - coalesce(sum(weight) FILTER (stops) OVER (), 0))::DOUBLE END AS target
  FROM c
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + least(greatest(budget % source_size - before, 0), size) END AS BIGINT) AS taken
FROM p
""",
    "op7_merkle": r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS t2
  FROM documents WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, coalesce(text, ''))
), e AS (
  SELECT *, substr(t, 1, n - n // 3) || substr(t2, 1, n // 3) AS t1 FROM n
), m AS (
  SELECT *,
    list_transform(string_split(t, chr(10)), lambda l: list_transform(regexp_extract_all(l, '[^.!?]{1,160}[.!?]{0,16}|[.!?]{1,16}'), lambda p: md5(p))) AS h,
    list_transform(string_split(t1, chr(10)), lambda l: list_transform(regexp_extract_all(l, '[^.!?]{1,160}[.!?]{0,16}|[.!?]{1,16}'), lambda p: md5(p))) AS h1,
    list_transform(string_split(t2, chr(10)), lambda l: list_transform(regexp_extract_all(l, '[^.!?]{1,160}[.!?]{0,16}|[.!?]{1,16}'), lambda p: md5(p))) AS h2
  FROM e
), f AS (
  SELECT doc_id, n, sha256(t1) AS edited_sha256, t = t1 AS same1, t = t2 AS same2,
    sha256(array_to_string(list_transform(h, lambda s: md5(coalesce(array_to_string(s, '.'), ''))), ';')) || '|' ||
      array_to_string(list_transform(h, lambda s: substr(md5(coalesce(array_to_string(s, '.'), '')), 1, 12) || '=' || coalesce(array_to_string(list_transform(s, lambda x: substr(x, 1, 12)), '.'), '')), ';') AS fingerprint,
    sha256(array_to_string(list_transform(h1, lambda s: md5(coalesce(array_to_string(s, '.'), ''))), ';')) || '|' ||
      array_to_string(list_transform(h1, lambda s: substr(md5(coalesce(array_to_string(s, '.'), '')), 1, 12) || '=' || coalesce(array_to_string(list_transform(s, lambda x: substr(x, 1, 12)), '.'), '')), ';') AS edited_fingerprint,
    list_distinct(list_transform(flatten(h), lambda x: substr(x, 1, 12))) AS a,
    list_distinct(list_transform(flatten(h1), lambda x: substr(x, 1, 12))) AS a1,
    list_distinct(list_transform(flatten(h2), lambda x: substr(x, 1, 12))) AS a2
  FROM m
)
SELECT doc_id, n AS n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN same1 THEN 1.0::DOUBLE ELSE (2 * len(list_intersect(a, a1)))::DOUBLE / greatest(len(a) + len(a1), 1) END AS near_edited,
  CASE WHEN same2 THEN 1.0::DOUBLE ELSE (2 * len(list_intersect(a, a2)))::DOUBLE / greatest(len(a) + len(a2), 1) END AS near_next
FROM f
""",
    "op11_vector_codes": vector_codes_sql(),
    "op12_divergence": divergence_sql(),
}
