"""Explicit schemas for every table the engine reads or writes (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_NAMED = T.ArrayType(T.StructType([T.StructField("name", _S)]))

ANNOTATIONS = T.StructType([
    T.StructField("uid", _S),
    T.StructField("name", _S),
    T.StructField("description", _S),
    T.StructField("tags", _NAMED),
    T.StructField("categories", _NAMED),
])

CATEGORY_INDEX = T.StructType([
    T.StructField("category", _S),
    T.StructField("uids", T.ArrayType(_S)),
    T.StructField("cat_pos", T.IntegerType()),
])

ASSET_FILES = T.StructType([
    T.StructField("uid", _S),
    T.StructField("mesh_path", _S),
])

METADATA = T.StructType([
    T.StructField("uid", _S),
    T.StructField("category", _S),
    T.StructField("description_raw", _S),
])

MANIFEST = T.StructType([
    T.StructField("uid", _S),
    T.StructField("category", _S),
    T.StructField("description", _S),
    T.StructField("voxel_path", _S),
    T.StructField("embedding_path", _S),
    T.StructField("source", _S),
])

FAILURES = T.StructType([
    T.StructField("uid", _S),
    T.StructField("reason", _S),
])

ENCODER_SPEC = T.StructType([
    T.StructField("backend", _S),
    T.StructField("model_name", _S),
    T.StructField("embedding_dim", T.IntegerType()),
])

EMBEDDINGS = T.StructType([
    T.StructField("uid", _S),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("spec", ENCODER_SPEC),
])

VERTICES = T.StructType([
    T.StructField("uid", _S),
    T.StructField("vid", T.IntegerType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
])

TRIANGLES = T.StructType(
    [T.StructField("uid", _S), T.StructField("fid", T.IntegerType())]
    + [T.StructField(f"{p}{a}", T.DoubleType()) for p in "abc" for a in "xyz"]
)

CELLS = T.StructType([
    T.StructField("uid", _S),
    T.StructField("x", T.ByteType()),
    T.StructField("y", T.ByteType()),
    T.StructField("z", T.ByteType()),
    T.StructField("value", T.FloatType()),
])

PROMPTS = T.StructType([
    T.StructField("prompt_id", _S),
    T.StructField("prompt", _S),
    T.StructField("seed", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
])

BATCH_LOSSES = T.StructType([
    T.StructField("run_id", _S),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("batch", T.IntegerType()),
    T.StructField("generator_loss", T.DoubleType()),
    T.StructField("discriminator_loss", T.DoubleType()),
])

RUN_PARAMS = T.StructType([
    T.StructField("run_id", _S),
    T.StructField("key", _S),
    T.StructField("value", _S),
])

RUN_METRICS = T.StructType([
    T.StructField("run_id", _S),
    T.StructField("step", T.IntegerType()),
    T.StructField("key", _S),
    T.StructField("value", T.DoubleType()),
])

MODEL_REGISTRY = T.StructType([
    T.StructField("model_id", _S),
    T.StructField("text_dim", T.IntegerType()),
    T.StructField("noise_dim", T.IntegerType()),
    T.StructField("encoder_backend", _S),
    T.StructField("encoder_model_name", _S),
    T.StructField("voxel_shape", T.ArrayType(T.IntegerType())),
    T.StructField("seed", T.IntegerType()),
    T.StructField("uri", _S),
])

REQUIRED_MANIFEST_COLUMNS = ("uid", "voxel_path", "embedding_path")
