"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, fingerprint, html_extract, line_dedup, mixing, near_dedup,
               prefix_trie, quality, substring_dedup, url_filter, warc, whitening)
from .storage import documents, table


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less its later repeated lines (runs of one line count), and less its later runs of two or more lines."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, min_lines=1, runs=2)
    return kept.select(
        "doc_id", F.col("_removed").cast("long").alias("n_removed"),
        F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("kept_sha256"),
        F.col("_run_removed").cast("long").alias("run_n_removed"),
        F.char_length("_run_text").cast("long").alias("run_n_chars"), F.sha2("_run_text", 256).alias("run_kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents WHERE text IS NOT NULL
), trimmed AS (
  SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k FROM trimmed WHERE key <> ''
), windows AS (
  SELECT a.doc_id, a.k, a.key || chr(10) || b.key AS w
  FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND b.k = a.k + 1
), later AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY w ORDER BY doc_id, k) AS occurrence FROM windows)
  WHERE occurrence > 1
), runs AS (
  SELECT doc_id, k FROM later UNION SELECT doc_id, k + 1 FROM later
), gone AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY key ORDER BY doc_id, k) AS occurrence FROM numbered)
  WHERE occurrence > 1
), marked AS (
  SELECT t.doc_id, t.place, t.line, g.k IS NOT NULL AS removed, r.k IS NOT NULL AS in_run
  FROM trimmed t LEFT JOIN numbered n ON n.doc_id = t.doc_id AND n.place = t.place
  LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.k = n.k
  LEFT JOIN runs r ON r.doc_id = n.doc_id AND r.k = n.k
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, count(*) FILTER (WHERE in_run) AS run_n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT removed), '') AS text,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT in_run), '') AS run_text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_removed, 0) AS n_removed, length(k.text) AS n_chars, sha256(k.text) AS kept_sha256,
       coalesce(k.run_n_removed, 0) AS run_n_removed, length(k.run_text) AS run_n_chars, sha256(k.run_text) AS run_kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix by weights 3, 1, 2 takes of each document (see ``mixing.Mix``)."""
    mix = mixing.Mix(documents(spark, sf_dir))
    return mix.per_document().select("doc_id", "size", "source_size", "target", "taken")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents (see ``near_dedup.near_groups``)."""
    return near_dedup.near_groups(documents(spark, sf_dir)).drop("text_hash", "node")


def op4_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text (see ``fingerprint.fingerprint_edits``)."""
    return fingerprint.fingerprint_edits(documents(spark, sf_dir)).drop("text_hash")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap (see ``decontaminate.contaminated``)."""
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op6_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document less the windows of 50 words that a smaller doc_id has."""
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back (see ``warc.archive_pages``)."""
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS lead FROM p
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN lead = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN lead = page_id THEN NULL ELSE lead END AS refers_to
FROM g
"""

#: The rules of op8: host, path, verdict.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url (see ``url_filter.judge``)."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = url_filter.filter_pages(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"),
                         F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


OP8_SQL = r"""
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), best AS (
  SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS k
  FROM parsed p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE k = 1
"""


def op9_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page (see ``html_extract.extract``)."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and decision for every document."""
    docs = documents(spark, sf_dir)
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels"))).drop("text_hash")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations (see ``prefix_trie.trie``)."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations")).drop("a", "b")


OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten([[ord(c)::UBIGINT] || [999::UBIGINT FOR i IN range(8)]
                                                             FOR c IN string_split(conv_id::VARCHAR, '')])),
           lambda crc, step: CASE WHEN step < 256 THEN xor(crc, step)
             ELSE xor(crc >> 1, CASE WHEN crc & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END) END),
             4294967295::UBIGINT)::BIGINT % 9 AS h
  FROM turns GROUP BY conv_id
), ids AS (
  SELECT *, dense_rank() OVER (ORDER BY role, text) AS id, octet_length(encode(text)) AS size FROM turns
), rebuilt AS (
  SELECT c.conv_id, t.pos AS d, t.id, t.size FROM convs c JOIN ids t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.id, t.size
  FROM convs c JOIN ids t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN convs b ON b.conv_id = c.base
), paths AS (
  SELECT c.conv_id, coalesce(list(r.id ORDER BY r.d) FILTER (WHERE r.id IS NOT NULL), []) AS path,
         coalesce(list(r.size ORDER BY r.d) FILTER (WHERE r.id IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), prefixes AS (
  SELECT conv_id, len(path) AS l, d, path[1:d] AS key, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT d AS depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE l = d), '')) AS ends_sha256
  FROM prefixes GROUP BY d, key
), children AS (
  SELECT key[1:depth - 1] AS key, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.key = n.key AND c.depth = n.depth
), below AS (
  SELECT key[1:up] AS key, up AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY 1, 2
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens,
       n.ends_sha256
FROM counted n JOIN below b ON b.key = n.key AND b.depth = n.depth
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]
"""


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by a public vocabulary, and its text decoded from them (see ``bpe.round_trip``)."""
    import public_tokenizers
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                              space_starts=True)
    return bpe.round_trip(documents(spark, sf_dir), tokenizer)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whitened on the four leading components (see ``whitening.whiten``)."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": Query(op1_line_dedup, OP1_SQL),
    "op2_mix_sources": Query(op2_mix_sources),
    "op3_minhash_near_dedup": Query(op3_minhash_near_dedup),
    "op4_chunk_fingerprints": Query(op4_chunk_fingerprints),
    "op5_decontaminate": Query(op5_decontaminate),
    "op6_difference_cover_dedup": Query(op6_difference_cover_dedup),
    "op7_warc_writer": Query(op7_warc_writer, OP7_SQL),
    "op8_url_filter": Query(op8_url_filter, OP8_SQL),
    "op9_block_labeller": Query(op9_block_labeller),
    "op10_quality_classifier": Query(op10_quality_classifier),
    "op11_prefix_trie": Query(op11_prefix_trie, OP11_SQL),
    "op12_byte_bpe": Query(op12_byte_bpe),
    "op13_embedding_whitening": Query(op13_embedding_whitening),
}
