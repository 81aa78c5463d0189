"""Warehouse layer: staging view, data-quality mart and column tests.

P01 F01 T16 A01-A04 Q01-Q05 F10 U01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS
from ..schemas import REQUIRED_MANIFEST_COLUMNS


def stage_assets(manifest: DataFrame) -> DataFrame:
    """``asset_id``, lower-cased category, text and feature paths."""
    return (manifest.where(F.col("uid").isNotNull())
            .select(F.col("uid").cast("string").alias("asset_id"),
                    F.lower("category").alias("category"),
                    "description", "voxel_path", "embedding_path"))


def blank(c) -> F.Column:
    """NULL or only whitespace (Python/warehouse ``trim`` sense, incl. NBSP)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | col.rlike("^" + WS + "*$")


def quality_mart(staged: DataFrame) -> DataFrame:
    """Per category counts of assets and missing fields.

    One hash aggregate; partial counts combine map-side, so a category holding
    a third of all rows costs one small row per map task in the shuffle.
    """
    return staged.groupBy("category").agg(
        F.count(F.lit(1)).alias("asset_count"),
        F.count_if(blank("description")).alias("missing_descriptions"),
        F.count_if(F.col("voxel_path").isNull()).alias("missing_voxels"),
        F.count_if(F.col("embedding_path").isNull()).alias("missing_embeddings"),
    )


def not_null_violations(staged: DataFrame, column: str = "asset_id") -> DataFrame:
    """Q01: rows failing ``not_null``."""
    return staged.where(F.col(column).isNull())


def unique_violations(staged: DataFrame, column: str = "asset_id") -> DataFrame:
    """Keys appearing more than once, with their count."""
    return (staged.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def column_tests(staged: DataFrame, column: str = "asset_id") -> DataFrame:
    """Q01 + Q02 as one table of offending keys ``(test, key, n_rows)``."""
    nn = (not_null_violations(staged, column)
          .groupBy().agg(F.count(F.lit(1)).alias("n_rows"))
          .where(F.col("n_rows") > 0)
          .select(F.lit("not_null").alias("test"), F.lit(None).cast("string").alias("key"), "n_rows"))
    un = (unique_violations(staged.where(F.col(column).isNotNull()), column)
          .select(F.lit("unique").alias("test"), F.col(column).cast("string").alias("key"), "n_rows"))
    return nn.unionByName(un)


def missing_columns(df: DataFrame, required=REQUIRED_MANIFEST_COLUMNS) -> list[str]:
    """Sorted required-minus-present column names."""
    return sorted(set(required) - set(df.columns))


def check_manifest(df: DataFrame, name: str = "manifest",
                   required=REQUIRED_MANIFEST_COLUMNS) -> DataFrame:
    """Non-empty, then required columns present; raises ``ValueError``."""
    if df.isEmpty():
        raise ValueError(f"Manifest contains no rows: {name}")
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Manifest is missing columns: {missing}")
    return df


def failure_summary(failures: DataFrame) -> DataFrame:
    """Q05: failures counted by the part of ``reason`` before the first ':'."""
    kind = F.substring_index(F.col("reason"), ":", 1)
    return failures.groupBy(kind.alias("reason_kind")).agg(F.count(F.lit(1)).alias("n_assets"))
