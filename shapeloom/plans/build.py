"""Dataset build jobs: catalog -> descriptions -> features -> manifest + failure log.

One lazy plan per stage; the keyed ``assets`` frame is written once to the
shared checkpoint folder and read back, so the success and failure branches
(and both feature branches) do not recompute it and survive lost executors.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.guard import guarded
from ..functions.text import failure_reason
from ..operators import catalog as cat
from ..operators import features as fe
from ..operators import voxels as vx
from ..session import scratch_table_dir
from ..sources import writers


@dataclass
class BuildResult:
    manifest: DataFrame
    failures: DataFrame
    cells: DataFrame
    embeddings: DataFrame


def _persisted(df: DataFrame, name: str) -> DataFrame:
    # a folder of this build's own: a later build leaves earlier results alone
    path = scratch_table_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def asset_split(clean: DataFrame, files: DataFrame, mesh_bounds: DataFrame | None = None,
                key: str = "uid") -> DataFrame:
    """Every cleaned asset with ``mesh_path`` and ``reason``
    (NULL = usable). One left join to the file inventory and one to the
    per-mesh bounds; the failure reason is a ``when`` chain, so one bad asset
    never stops the build."""
    f = files.select(key, "mesh_path")
    j = clean.join(f, key, "left")
    path = F.col("mesh_path")
    reason = F.when(F.coalesce(path, F.lit("")) == "", F.lit("download_missing"))
    if mesh_bounds is not None:
        b = mesh_bounds.select(key, "n_points", "max_extent")
        j = j.join(b, key, "left")
        reason = (reason
                  .when(F.coalesce(F.col("n_points"), F.lit(0)) == 0,
                        failure_reason("ValueError", F.concat(F.lit("Empty mesh: "), path)))
                  .when(F.isnan("max_extent") | (F.col("max_extent") == float("inf")),
                        failure_reason("ValueError", F.concat(F.lit("Non-finite mesh: "), path)))
                  .when(F.col("max_extent") <= 0,
                        failure_reason("ValueError", F.concat(F.lit("Degenerate mesh: "), path))))
        return j.withColumn("reason", reason).drop("n_points", "max_extent")
    return j.withColumn("reason", reason)


def manifest_rows(ok: DataFrame, root: str, source: str, key: str = "uid") -> DataFrame:
    """The six manifest columns with logical feature keys."""
    return ok.select(
        F.col(key).alias("uid"), "category", "description",
        F.concat(F.lit(root.rstrip("/") + "/voxels/"), F.col(key), F.lit(".pt")).alias("voxel_path"),
        F.concat(F.lit(root.rstrip("/") + "/embeddings/"), F.col(key), F.lit(".pt")).alias("embedding_path"),
        F.lit(source).alias("source"))


def build_catalog_dataset(index: DataFrame, annotations: DataFrame, files: DataFrame,
                          triangles: DataFrame, categories=None, limit: int | None = None,
                          output_dir: str | None = None, dim: int = 256, size: int = 32,
                          voxel_size: float = 0.05, source: str = "objaverse", encoder=None) -> BuildResult:
    """The catalog build: S02-S04 -> T04 -> T03/F02/W01 -> J02 -> V04b..V11 + E01.

    ``encoder`` is a factory of ``predict(texts) -> vectors`` to use in place of
    the feature hash. An asset on which it fails is a failure row with the
    exception as its reason (F08), and the build goes on without it.

    ``triangles`` is the mesh table keyed by ``uid`` (a mesh decoder writes it).
    Raises like the original when nothing usable is left, after writing the
    failure log (so it is never lost).
    """
    members = cat.select_categories(cat.category_members(index), categories, limit)
    clean = cat.clean_manifest(cat.category_metadata(members, annotations))
    if clean.isEmpty():
        raise RuntimeError(f"No usable metadata found for category={categories!r}")
    tri = triangles.join(clean.select("uid"), "uid", "left_semi")
    corners = tri.select("uid", F.explode(F.array(*[F.struct(*[F.col(f"{p}{a}").alias(a) for a in "xyz"])
                                                     for p in "abc"])).alias("v"))
    bounds = vx.mesh_bounds(corners.select("uid", "v.x", "v.y", "v.z"))
    split = asset_split(clean, files, bounds)
    if encoder is not None:
        usable = F.col("reason").isNull()
        split = split.withColumn("_e", guarded(encoder, "array<float>")(F.when(usable, F.col("description"))))
        split = split.withColumn("reason", F.coalesce("reason", F.when(usable, F.col("_e.reason"))))
        split = split.withColumn("_e", F.col("_e.value"))
    assets = _persisted(split, "assets")
    ok = assets.where(F.col("reason").isNull())
    failures = assets.where(F.col("reason").isNotNull()).select("uid", "reason")
    surface = _persisted(vx.voxelize_triangles(tri.join(ok.select("uid"), "uid", "left_semi"), voxel_size),
                         "surface_cells")
    cells = vx.resize_nearest(surface, size)
    if encoder is None:
        emb = fe.hash_embed(ok.select("uid", "description"), "uid", "description", dim=dim)
    else:
        emb = ok.select("uid", F.col("_e").alias("embedding"), fe.encoder_spec("custom", "given", dim).alias("spec"))
    root = output_dir or "data/processed"
    manifest = manifest_rows(ok, root, source)
    if output_dir:
        writers.write_failures(failures, output_dir)
    if ok.isEmpty():
        raise RuntimeError("Dataset build produced zero valid assets")
    if output_dir:
        writers.write_features(cells, f"{root}/cells.parquet")
        writers.write_features(emb, f"{root}/embeddings.parquet")
        writers.write_manifest(manifest, output_dir)
    return BuildResult(manifest, failures, cells, emb)


def build_synthetic_dataset(ids: DataFrame, output_dir: str | None = None, dim: int = 256,
                            size: int = 32, id_col: str = "id") -> BuildResult:
    """S10 chain: manifest rows, shape cells (V01) and hash embeddings."""
    root = output_dir or "data/processed"
    m = cat.synthetic_manifest(ids, id_col, root)
    cells = vx.shape_cells(m, size)
    emb = fe.hash_embed(m.select("uid", "description"), "uid", "description", dim=dim)
    manifest = m.select("uid", "category", "description", "voxel_path", "embedding_path", "source")
    failures = m.limit(0).select("uid", F.lit(None).cast("string").alias("reason"))
    if output_dir:
        writers.write_failures(failures, output_dir)
        writers.write_features(cells, f"{root}/cells.parquet")
        writers.write_features(emb, f"{root}/embeddings.parquet")
        writers.write_manifest(manifest, output_dir)
    return BuildResult(manifest, failures, cells, emb)
