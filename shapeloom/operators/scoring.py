"""Batch prompt scoring and mesh publishing.

A request table ``prompts(prompt_id, prompt, seed, threshold)`` replaces the
one-at-a-time HTTP call: invalid requests become rows of a rejects table with
a reason, valid ones are embedded, given seeded noise, scored by a
user-supplied model in Arrow batches, and turned into surface meshes.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.guard import guarded
from ..session import scratch_table_dir
from . import features as fe
from . import surface as sf
from . import voxels as vx

MAX_PROMPT = 300
DEFAULT_THRESHOLD = 0.5
DEFAULT_MODEL_NAME = "google-t5/t5-base"


def prompt_reason(prompt: Column, threshold: Column) -> Column:
    """F12 then F11: request bounds, then a non-blank prompt after strip."""
    n = F.length(prompt)
    stripped = F.trim(F.regexp_replace(F.coalesce(prompt, F.lit("")), "^" + tx.WS + "+|" + tx.WS + "+$", ""))
    return (F.when(prompt.isNull() | (n < 1), F.lit("prompt: String should have at least 1 character"))
            .when(n > MAX_PROMPT, F.lit(f"prompt: String should have at most {MAX_PROMPT} characters"))
            .when(threshold.isNull() | (threshold <= 0), F.lit("threshold: Input should be greater than 0"))
            .when(threshold >= 1, F.lit("threshold: Input should be less than 1"))
            .when(stripped == "", F.lit("Prompt must not be empty")))


def validate_prompts(prompts: DataFrame) -> DataFrame:
    """Adds ``threshold`` default, the stripped prompt and ``reason`` (NULL = accepted)."""
    thr = F.coalesce(F.col("threshold").cast("double"), F.lit(DEFAULT_THRESHOLD)) \
        if "threshold" in prompts.columns else F.lit(DEFAULT_THRESHOLD)
    strip = F.regexp_replace(F.col("prompt"), "^" + tx.WS + "+|" + tx.WS + "+$", "")
    p = prompts.withColumn("threshold", thr).withColumn("stripped", strip)
    return p.withColumn("reason", prompt_reason(F.col("prompt"), F.col("threshold")))


def publish_names(prompts: DataFrame, key: str = "prompt_id", root: str = "artifacts/generated") -> DataFrame:
    """Slug stem, deterministic file name, mesh path and download URL."""
    stem = tx.slug(F.col("prompt"))
    name = tx.mesh_filename(stem, F.col(key))
    return prompts.select("*", stem.alias("stem"), name.alias("filename"),
                          F.concat(F.lit(root + "/"), name).alias("mesh_path"),
                          F.concat(F.lit("/meshes/"), name).alias("download_url"))


def seeded_noise(key: Column, seed: Column, noise_dim: int) -> Column:
    """Standard-normal vector per request, a function of ``(seed, key)`` only
    (Box-Muller over two 53-bit uniforms from ``xxhash64``), so it does not depend
    on partitioning or task retries. A NULL seed falls back to the key."""
    if not noise_dim:
        return F.array().cast("array<float>")
    s = F.coalesce(seed.cast("long"), F.xxhash64(key))
    two53 = float(2 ** 53)

    def unif(k, salt):
        h = F.xxhash64(s, k, F.lit(salt))
        return (F.pmod(h, F.lit(2 ** 53)).cast("double") + F.lit(0.5)) / F.lit(two53)

    return F.transform(F.sequence(F.lit(0), F.lit(noise_dim - 1)),
                       lambda k: (F.sqrt(F.lit(-2.0) * F.log(unif(k, 1)))
                                  * F.cos(F.lit(2 * math.pi) * unif(k, 2))).cast("float"))


def encoder_column(text: Column, backend: str, model_name: str, dim: int, encoders: dict | None = None,
                   batch_size: int = 64) -> Column:
    """E03 as a column: the embedding of ``text`` by the encoder that a registry row names.

    ``hash`` is the feature hash (a model name that ends in ``-md5`` takes that
    digest); any other backend runs ``encoders[model_name]``, a factory as in
    :func:`features.embed`.
    """
    b = (backend or "").lower()
    if b not in fe.BACKENDS:
        raise ValueError(f"Unknown text encoder backend: {backend}")
    if b == "hash":
        return fe.vector_column(text, dim, "md5" if (model_name or "").endswith("-md5") else "blake2b")
    if model_name not in (encoders or {}):
        raise ValueError(f"no encoder given for {model_name}")
    from pyspark.ml.functions import predict_batch_udf
    return predict_batch_udf(encoders[model_name], return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)(
        F.coalesce(text, F.lit("")))


def score_prompts(prompts: DataFrame, model_factory, text_dim: int = 256, noise_dim: int = 128,
                  size: int = 32, batch_size: int = 64, encoder: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(cells, rejects)``.

    ``model_factory()`` returns ``predict(inputs: np.ndarray[n, text_dim+noise_dim])
    -> np.ndarray[n, size^3]`` (voxel probabilities); ``predict_batch_udf`` loads it
    once per Python worker and feeds Arrow batches. The embedding (``encoder``, a
    column over ``stripped``; the feature hash by default) is a column of the
    row, so rows that share a prompt_id, or have none, each give one grid.
    Cells carry the prompt's ``threshold``; a prompt whose grid is all zero
    keeps one zero cell at the origin, so every valid prompt has cells.
    """
    from pyspark.ml.functions import predict_batch_udf

    v = validate_prompts(prompts)
    rejects = v.where(F.col("reason").isNotNull()).select("prompt_id", "prompt", "reason")
    ok = v.where(F.col("reason").isNull())
    embedding = fe.vector_column("stripped", text_dim) if encoder is None else encoder
    x = ok.select("prompt_id", "threshold", F.concat(
        embedding, seeded_noise(F.col("prompt_id"), F.col("seed"), noise_dim)).alias("x"))
    udf = predict_batch_udf(model_factory, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size, input_tensor_shapes=[[text_dim + noise_dim]])
    grids = x.select("prompt_id", "threshold", udf("x").alias("grid"))
    grids = grids.withColumnRenamed("prompt_id", "uid")
    cells = vx.from_dense(grids, size=size, keep_zeros="origin", carry=["threshold"])
    return cells, rejects


@dataclass(frozen=True)
class PromptMeshes:
    """``requests``: a row per input row; ``vertices`` and ``triangles`` by ``request`` (see ``surface.dual_surface``)."""

    requests: DataFrame
    vertices: DataFrame
    triangles: DataFrame


def _by_rows(factory, length: int):
    """A grid model as ``guarded`` takes it: rows of inputs in, a grid of ``length`` cells a row out."""
    def make():
        predict = factory()

        def run(rows):
            grids = predict(np.stack(list(rows)).astype(np.float32))
            flat = [np.asarray(g, dtype=np.float32).ravel() for g in grids]
            for g in flat:
                if len(g) != length:
                    raise ValueError(f"Expected a 3D voxel grid of {length} cells, got {len(g)}")
            return flat
        return run
    return make


def prompt_meshes(prompts: DataFrame, registry: DataFrame, model_id: str, generators: dict, encoders: dict | None = None,
                  batch_size: int = 64) -> PromptMeshes:
    """X07 and X08 in one job: prompts to named meshes.

    The registry row of ``model_id`` says which encoder embeds the prompt, how
    much noise is added and the grid's side; ``generators[model_id]`` is the
    model's factory. Each grid has its own level (V14, from the prompt's
    threshold and the grid's range); its closed surface (V15) is centred and
    scaled to unit extent (V16).

    ``requests`` has prompt_id, prompt, seed, threshold, request, reason, level,
    n_vertices, n_triangles, filename, mesh_path and download_url (P08); the
    names are null where ``reason`` says why there is no mesh: an invalid
    request (F11, F12), a model that fails on it or gives another number of
    cells or non-finite ones (F08, F14), or a grid without a surface. Rows
    equal in all inputs are one request, scored once, and each keeps its row;
    a repeated or null prompt_id is no key.
    """
    found = runtime_config(registry, model_id).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{len(found)} registry rows for model {model_id}")
    config = found[0]
    size = config.voxel_shape[0]
    if list(config.voxel_shape) != [size] * 3:
        raise ValueError(f"Expected a cubic grid, got {list(config.voxel_shape)}")
    spark = prompts.sparkSession
    folder = scratch_table_dir(spark, f"prompt-meshes-{uuid.uuid4().hex}")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    rows = prompts if "seed" in prompts.columns else prompts.withColumn("seed", F.lit(None).cast("long"))
    rows = validate_prompts(rows).groupBy("prompt_id", "prompt", "stripped", "seed", "threshold", "reason").agg(
        F.count(F.lit(1)).alias("copies"))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("?"))
    rows = kept(rows.withColumn("request", F.sha2(F.concat_ws("\x1f", *map(named, ("prompt_id", "prompt", "seed", "threshold"))), 256)),
                "requests")
    embedding = encoder_column(F.col("stripped"), config.encoder_backend, config.encoder_model_name, config.text_dim, encoders, batch_size)
    model = guarded(_by_rows(generators[model_id], size ** 3), "array<float>", batch_size)
    x = rows.where("reason is null").select("request", "threshold", F.concat(
        embedding, seeded_noise(F.col("request"), F.col("seed"), config.noise_dim)).alias("x"))
    grids = kept(x.select("request", "threshold", model(F.col("x")).alias("g")).select("request", "threshold", "g.*"), "grids")
    good = grids.where("reason is null").select("request", "threshold", F.col("value").alias("grid"))
    # laid out by key, so that no cell is sent; a task has about a million cells at most, but at least one grid
    cells = vx.from_dense(vx.by_key(good, "request", max(1, min(500, 2 ** 20 // size ** 3))), size=size, key="request")
    stats = good.select("request", "threshold").join(vx.grid_stats(cells, size, key="request"), "request", "left").fillna(
        0, ["n_cells", "n_nonfinite", "grid_min", "grid_max"])
    levels = kept(vx.adaptive_level(stats, F.col("threshold")).select("request", "level", "reason"), "levels")
    at = cells.join(levels.where("reason is null").select("request", "level"), "request")
    vertices, triangles = sf.dual_surface(at, F.col("level"), key="request")
    vertices, triangles = kept(vertices, "vertices"), kept(triangles, "triangles")
    counts = [t.groupBy("request").agg(F.count(F.lit(1)).alias(n)) for t, n in ((vertices, "n_vertices"), (triangles, "n_triangles"))]
    out = rows.withColumnRenamed("reason", "_invalid")
    for part in (grids.select("request", F.col("reason").alias("_failed")), levels.withColumnRenamed("reason", "_flat"), *counts):
        out = out.join(part, "request", "left")
    out = out.withColumn("reason", F.coalesce("_invalid", "_failed", "_flat"))
    out = publish_names(out, key="request")
    has = F.col("reason").isNull()
    names = ["filename", "mesh_path", "download_url"]
    # rows equal in all come out one by one
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    requests = out.select("prompt_id", "prompt", "seed", "threshold", "request", "reason", "level",
                          *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("n_vertices", "n_triangles")],
                          *[F.when(has, F.col(n)).alias(n) for n in names])
    return PromptMeshes(requests, vx.normalise_vertices(vertices, key="request"), triangles)


def surface_mesh(cells: DataFrame, level: float | Column = 0.5, key: str = "uid") -> tuple[DataFrame, DataFrame]:
    """A closed quad surface of the occupied cells as ``(vertices, triangles)``.

    Occupied = value above the level. Every boundary face (V15b) contributes
    two triangles over its four corners; corners are shared lattice points, so
    the vertex table is their distinct set. Coordinates are lattice units.
    """
    lv = level if isinstance(level, Column) else F.lit(float(level))
    faces = vx.boundary_faces(cells, key, occupied=F.col("value") > lv)
    # corner offsets of each face (counter-clockwise seen from outside)
    quads = {
        "+x": ((1, 0, 0), (1, 1, 0), (1, 1, 1), (1, 0, 1)),
        "-x": ((0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 0)),
        "+y": ((0, 1, 0), (0, 1, 1), (1, 1, 1), (1, 1, 0)),
        "-y": ((0, 0, 0), (1, 0, 0), (1, 0, 1), (0, 0, 1)),
        "+z": ((0, 0, 1), (1, 0, 1), (1, 1, 1), (0, 1, 1)),
        "-z": ((0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 0)),
    }
    fid = F.xxhash64(F.col(key), "x", "y", "z", "face")

    def corner(k):
        exprs = []
        for a_i, a in enumerate("xyz"):
            e = None
            for face, cs in quads.items():
                val = F.lit(cs[k][a_i])
                e = F.when(F.col("face") == face, val) if e is None else e.when(F.col("face") == face, val)
            exprs.append((F.col(a) + e).cast("double").alias(a))
        return F.struct(*exprs)

    fc = faces.select(key, fid.alias("fid"), F.array(*[corner(k) for k in range(4)]).alias("c"))
    tris = fc.select(key, "fid", F.explode(F.array(
        F.struct(F.col("c")[0].alias("a"), F.col("c")[1].alias("b"), F.col("c")[2].alias("c")),
        F.struct(F.col("c")[0].alias("a"), F.col("c")[2].alias("b"), F.col("c")[3].alias("c")))).alias("t"))
    tris = tris.select(key, "fid", *[F.col(f"t.{p}.{a}").alias(f"{p}{a}") for p in "abc" for a in "xyz"])
    verts = fc.select(key, F.explode("c").alias("v")).select(key, "v.x", "v.y", "v.z").distinct()
    return verts, tris


def mesh_lookup(requests: DataFrame, inventory: DataFrame, req_col: str = "filename",
                name_col: str = "filename") -> DataFrame:
    """Reduce a requested name to its basename, then look it up."""
    r = requests.select(F.col(req_col).alias("request"), tx.path_basename(F.col(req_col)).alias("safe_name"))
    inv = inventory.select(F.col(name_col).alias("safe_name"), F.lit(True).alias("found")).distinct()
    return r.join(inv, "safe_name", "left").select(
        "request", "safe_name", F.coalesce("found", F.lit(False)).alias("found"))


def runtime_config(registry: DataFrame, model_id: str) -> DataFrame:
    """One model's metadata with the encoder name defaulted."""
    r = registry.where(F.col("model_id") == model_id)
    return r.withColumn("encoder_model_name", F.coalesce("encoder_model_name", F.lit(DEFAULT_MODEL_NAME)))
