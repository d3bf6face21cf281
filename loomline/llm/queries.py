"""The registered queries of this subpackage and their SQL: thin readers of the operators beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import in_order, plan

    return in_order(plan(table(spark, sf_dir, "documents")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import report

    return report(table(spark, sf_dir, "documents"))


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scans import report

    return report(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .url_filters import judge, junk_page, listed_page

    return judge(table(spark, sf_dir, "pages"), bad=listed_page(F.col("url")) | junk_page(F.col("html")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import dedup

    return dedup(table(spark, sf_dir, "documents")).drop("spans")


def op6_automata_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .automata_dedup import dedup

    return dedup(table(spark, sf_dir, "documents")).drop("n_spans")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digests

    return digests(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash_dedup import classes

    return classes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans, "op2_suffix_dedup": op2_suffix_dedup, "op3_mixing": op3_mixing, "op4_quality_rules": op4_quality_rules,
    "op5_url_filters": op5_url_filters, "op6_automata_dedup": op6_automata_dedup, "op7_topk": op7_topk, "op8_bpe": op8_bpe, "op9_warc": op9_warc, "op10_minhash_dedup": op10_minhash_dedup,
}

OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
tri AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM hit, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, length(t) - length(replace(t, '!', '')) AS n_bangs
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 20 > word_chars OR n_bangs * 10 > word_chars OR (n_dup_lines > 2 AND n_dup_lines * 2 > n_lines)
            OR word_chars > n_words * 25 OR word_chars < n_words * 2) AS kept
FROM b
"""

OP6_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT r, doc_id, i, array_to_string(ws[i:i+12], ' ') AS g FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
hit AS (
  SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id OR (doc_id IS NULL AND least IS NOT NULL)),
gone AS (
  SELECT r, list(DISTINCT i + k) AS places FROM hit, range(13) AS o(k) GROUP BY r),
k AS (
  SELECT doc_id, len(ws) AS n, CASE WHEN places IS NULL THEN ws ELSE list_filter(ws, lambda x, j: NOT list_contains(places, j)) END AS kept FROM w LEFT JOIN gone USING (r))
SELECT doc_id, n::BIGINT AS n_words, (n - len(kept))::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""

OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP9_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

SQL = {"op4_quality_rules": OP4_SQL, "op6_automata_dedup": OP6_SQL, "op7_topk": OP7_SQL, "op9_warc": OP9_SQL}
