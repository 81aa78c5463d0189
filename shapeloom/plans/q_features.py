"""Embedding feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from .registry import query, table

_TOKENS_SQL = """
  t0 AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9-]+') AS toks
         FROM documents),
  t AS (SELECT doc_id, unnest(CASE WHEN len(toks) = 0 THEN ['empty'] ELSE toks END) AS token FROM t0)"""


@query("hash_embed_md5", "E01 T06 A13 A12 M01", oracle=f"""
  WITH {_TOKENS_SQL},
  h AS (SELECT doc_id, CAST(('0x' || substr(md5(token), 1, 8))::BIGINT % 64 AS INTEGER) AS slot,
               CASE WHEN ('0x' || substr(md5(token), 9, 2))::INTEGER % 2 = 0 THEN 1.0 ELSE -1.0 END
                 AS sign FROM t),
  s AS (SELECT doc_id, slot, SUM(sign) AS w FROM h GROUP BY doc_id, slot),
  n AS (SELECT doc_id, sqrt(SUM(w * w)) AS norm FROM s GROUP BY doc_id)
  SELECT s.doc_id, s.slot, round(CAST(CAST(CAST(s.w AS DOUBLE) / n.norm AS FLOAT) AS DOUBLE), 6) AS weight
  FROM s JOIN n ON s.doc_id = n.doc_id WHERE s.w <> 0
""")
def q_hash_embed_md5(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    e = fe.hash_embed(d, "doc_id", "text", dim=64, hasher="md5")
    s = e.select("doc_id", F.posexplode("embedding").alias("slot", "weight"))
    return s.where(F.col("weight") != 0).select("doc_id", "slot", F.round(F.col("weight").cast("double"), 6).alias("weight"))


@query("hash_embed", "E01 E04 E05 T07 UDF-1")
def q_hash_embed(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fe.hash_embed(d, "doc_id", "text", dim=256, hasher="blake2b")


_LONG_SQL = """
  e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim,
               CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""


@query("mean_pool", "A09", oracle=f"""
  WITH {_LONG_SQL}
  SELECT label, dim, round(avg(v), 6) AS value FROM e GROUP BY label, dim
""")
def q_mean_pool(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    p = fe.mean_pool(e, "label")
    return p.select("label", "dim", F.round("value", 6).alias("value"))


@query("masked_mean_pool", "A08", oracle=f"""
  WITH {_LONG_SQL}
  SELECT label, dim,
         round(SUM(v * CASE WHEN vec_id % 3 <> 0 THEN 1.0 ELSE 0.0 END)
               / greatest(SUM(CASE WHEN vec_id % 3 <> 0 THEN 1.0 ELSE 0.0 END), 1.0), 6) AS value
  FROM e GROUP BY label, dim
""")
def q_masked_mean_pool(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    p = fe.mean_pool(e, "label", mask=(F.col("vec_id") % 3 != 0))
    return p.select("label", "dim", F.round("value", 6).alias("value"))


@query("l2_normalise", "A12 M01", oracle=f"""
  WITH {_LONG_SQL},
  n AS (SELECT vec_id, sqrt(SUM(v * v)) AS norm FROM e GROUP BY vec_id)
  SELECT e.vec_id, e.dim, round(CASE WHEN n.norm > 0 THEN e.v / n.norm ELSE 0 END, 6) AS value
  FROM e JOIN n ON e.vec_id = n.vec_id
""")
def q_l2_normalise(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    u = e.select("vec_id", fe.l2_normalise(e).alias("u"))
    return u.select("vec_id", F.posexplode("u").alias("dim", "value")).select(
        "vec_id", "dim", F.round("value", 6).alias("value"))
