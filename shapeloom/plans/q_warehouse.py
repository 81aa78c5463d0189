"""Warehouse queries over a manifest derived from ``documents`` ⟕ ``labels``.

The driver tables hold no asset catalog, so ``documents`` plays one:
``uid = doc_id`` (NULL for a stride of ids to exercise F01), ``category = source``
(upper-cased for German rows to exercise T16), ``description = text`` with blank
values injected, and a feature is "missing" when the document has no label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WS
from ..operators import quality as q
from .registry import query, table

NBSP_BLANK = "\u00a0  "


def documents_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("has_label"))
    d = docs.join(labels, "doc_id", "left")
    did = F.col("doc_id")
    return d.select(
        "doc_id",
        F.when(did % 97 == 0, F.lit(None)).otherwise(did.cast("string")).alias("uid"),
        F.when(F.col("lang") == "de", F.upper("source")).otherwise(F.col("source")).alias("category"),
        F.when(did % 50 == 1, F.lit(""))
         .when(did % 50 == 2, F.lit(None))
         .when(did % 50 == 3, F.lit(NBSP_BLANK))
         .otherwise(F.col("text")).alias("description"),
        F.when(F.col("n_chars") % 11 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("voxels/"), did.cast("string"), F.lit(".pt"))).alias("voxel_path"),
        F.when(F.col("has_label").isNull(), F.lit(None))
         .otherwise(F.concat(F.lit("embeddings/"), did.cast("string"), F.lit(".pt"))).alias("embedding_path"),
        F.lit("documents").alias("source"),
    )


MANIFEST_SQL = """
  SELECT d.doc_id,
         CASE WHEN d.doc_id % 97 = 0 THEN NULL ELSE CAST(d.doc_id AS VARCHAR) END AS uid,
         CASE WHEN d.lang = 'de' THEN upper(d.source) ELSE d.source END AS category,
         CASE WHEN d.doc_id % 50 = 1 THEN ''
              WHEN d.doc_id % 50 = 2 THEN NULL
              WHEN d.doc_id % 50 = 3 THEN chr(160) || '  '
              ELSE d.text END AS description,
         CASE WHEN d.n_chars % 11 = 0 THEN NULL
              ELSE 'voxels/' || CAST(d.doc_id AS VARCHAR) || '.pt' END AS voxel_path,
         CASE WHEN l.doc_id IS NULL THEN NULL
              ELSE 'embeddings/' || CAST(d.doc_id AS VARCHAR) || '.pt' END AS embedding_path,
         'documents' AS source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

STAGE_SQL = f"""
  SELECT uid AS asset_id, lower(category) AS category, description, voxel_path, embedding_path
  FROM ({MANIFEST_SQL}) m WHERE uid IS NOT NULL
"""


@query("stage_assets", "P01 F01 T16 S07 K07", oracle=STAGE_SQL)
def stage_assets(spark, sf_dir):
    return q.stage_assets(documents_manifest(spark, sf_dir))


@query("quality_mart", "A01 A02 A03 A04 Q03", oracle=f"""
  SELECT category,
         COUNT(*) AS asset_count,
         CAST(SUM(CASE WHEN description IS NULL
                        OR regexp_matches(description, '^{WS}*$') THEN 1 ELSE 0 END) AS BIGINT)
           AS missing_descriptions,
         CAST(SUM(CASE WHEN voxel_path IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_voxels,
         CAST(SUM(CASE WHEN embedding_path IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_embeddings
  FROM ({STAGE_SQL}) s
  GROUP BY 1
""")
def quality_mart(spark, sf_dir):
    return q.quality_mart(q.stage_assets(documents_manifest(spark, sf_dir)))


# Content-addressed assets: the same text twice is the same asset, so the
# unique test reports every duplicated text key.
@query("dq_column_tests", "Q01 Q02 A15", oracle=f"""
  SELECT 'unique' AS test, md5(description) AS key, COUNT(*) AS n_rows
  FROM ({STAGE_SQL}) s
  WHERE md5(description) IS NOT NULL
  GROUP BY md5(description) HAVING COUNT(*) > 1
  UNION ALL
  SELECT 'not_null' AS test, CAST(NULL AS VARCHAR) AS key, COUNT(*) AS n_rows
  FROM ({STAGE_SQL}) s WHERE md5(description) IS NULL HAVING COUNT(*) > 0
""")
def dq_column_tests(spark, sf_dir):
    staged = q.stage_assets(documents_manifest(spark, sf_dir))
    keyed = staged.withColumn("asset_id", F.md5("description"))
    return q.column_tests(keyed, "asset_id")
