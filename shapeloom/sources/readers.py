"""Sources (S01-S07). Every read names its schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import path_stem


def read_manifest(spark: SparkSession, path: str, schema=schemas.MANIFEST) -> DataFrame:
    """Format by case-insensitive suffix: ``.csv`` / ``.parquet`` / ``.pq``.

    Columns go by name, whatever their order in the file; those of ``schema``
    that the file lacks stay missing (F10 reports them).
    """
    p = path.rstrip("/")
    dot = p.rfind(".")
    suffix = p[dot:].lower() if dot > p.rfind("/") else ""
    if suffix == ".csv":
        found = spark.read.option("header", True).csv(path)
    elif suffix in (".parquet", ".pq"):
        found = spark.read.parquet(path)
    else:
        raise ValueError(f"Unsupported manifest format: {suffix}")
    return found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name in found.columns])


def read_category_index(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``(category, uids array<string>, cat_pos)``; ``cat_pos`` is the
    category's place in the index, as row order is not kept."""
    return spark.read.schema(schemas.CATEGORY_INDEX).format(fmt).load(path)


def read_annotations(spark: SparkSession, path: str, uids: DataFrame | None = None,
                     fmt: str = "json") -> DataFrame:
    """Annotation records; with ``uids`` only the requested ones are kept
    (a semi-join, so the big side is never joined in full)."""
    ann = spark.read.schema(schemas.ANNOTATIONS).format(fmt).load(path)
    if uids is not None:
        ann = ann.join(uids.select("uid").distinct(), "uid", "left_semi")
    return ann


def read_keyed(spark: SparkSession, path: str, requests: DataFrame, key: str = "uid", parts: int = 256) -> DataFrame:
    """Rows of the requested keys from a table that ``writers.write_keyed`` wrote with the same ``parts``.

    The folders that the requested keys hash to, at most ``parts`` numbers, are
    named in the scan, so a small request reads few files, whatever the table's
    size. Null keys match nothing; a key requested twice gives its rows once.
    """
    wanted = requests.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    part = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")
    numbers = sorted(r[0] for r in wanted.select(part.alias("p")).distinct().collect())
    table = spark.read.parquet(path)
    return table.where(F.col("_part").isin(numbers)).drop("_part").join(wanted, key, "left_semi")


def asset_inventory(spark: SparkSession, root: str, glob: str = "*.glb", suffix: str = ".glb") -> DataFrame:
    """``(uid, mesh_path, length, modificationTime)`` for mesh files
    under ``root`` (recursive). Only file metadata is read: the ``content``
    column is pruned, so no bytes move."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root)
             .select("path", "length", "modificationTime"))
    return files.select(path_stem(F.col("path"), suffix).alias("uid"), F.col("path").alias("mesh_path"),
                        "length", "modificationTime")


def read_features(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A feature table (``cells`` or ``embeddings``) keyed by ``uid``."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A warehouse table or view by name."""
    return spark.table(name)
