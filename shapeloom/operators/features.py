"""Text embedding features.

Signed feature hashing (E01) is row-local: the JVM regex cuts a row's tokens,
and an Arrow UDF sums their signs per slot and normalises in one pass, with
the digests of recent tokens kept per worker. Nothing is shuffled or
broadcast, and rows with an equal key stay apart.

``slot_weights`` with the ``md5`` hasher is the same in JVM expressions (used
as the DuckDB oracle twin, since DuckDB has no BLAKE2b).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import EMPTY_TOKEN, split_words, token_runs

HASH_MODEL_NAME = "deterministic-hash-v1"
BACKENDS = ("t5", "hash")


def encoder_spec(backend: str, model_name: str, dim: int) -> Column:
    """Lineage struct stamped on every feature row."""
    return F.struct(F.lit(backend).alias("backend"), F.lit(model_name).alias("model_name"),
                    F.lit(int(dim)).cast("int").alias("embedding_dim"))


def _row_weights(dim: int, hasher: str):
    """T07 + A13 for one row's tokens: ``{slot: signed sum}``.

    The digest's first 8 bytes, little endian (md5: first 4, big endian),
    modulo ``dim`` give the slot and the parity of the next byte the sign; a
    worker keeps the digests of recent tokens. A row without tokens has the
    ``empty`` token.
    """
    if dim <= 0:
        raise ValueError("dim must be positive")
    if hasher not in ("blake2b", "md5"):
        raise ValueError(f"Unknown hasher: {hasher}")
    nothing = EMPTY_TOKEN

    def make():
        import hashlib as _h
        from functools import lru_cache as _cache

        @_cache(maxsize=100_000)
        def place(token):
            if hasher == "md5":
                d = _h.md5(token.encode("utf-8")).digest()
                return int.from_bytes(d[:4], "big") % dim, 1.0 if d[4] % 2 == 0 else -1.0
            d = _h.blake2b(token.encode("utf-8"), digest_size=16).digest()
            return int.from_bytes(d[:8], "little") % dim, 1.0 if d[8] % 2 == 0 else -1.0

        def sums(tokens):
            out = {}
            for t in tokens if tokens is not None and len(tokens) else (nothing,):
                slot, sign = place(t)
                out[slot] = out.get(slot, 0.0) + sign
            return out
        return sums
    return make


def _token_lists(rows: pa.Array) -> Iterator[list]:
    """Each row's tokens; those of one row at a time are Python strings, the others stay in the Arrow batch."""
    bounds, flat, known = rows.offsets.to_numpy(), rows.values, rows.is_valid().to_pylist()
    for k, there in enumerate(known):
        yield flat.slice(bounds[k], bounds[k + 1] - bounds[k]).to_pylist() if there else []


def _weight_lists(rows: pa.Array, sums) -> pa.Array:
    ends, slots, weights = [0], [], []
    for tokens in _token_lists(rows):
        own = sorted(sums(tokens).items())
        slots.append(np.array([k for k, _ in own], dtype=np.int32))
        weights.append(np.array([w for _, w in own], dtype=np.float64))
        ends.append(ends[-1] + len(own))
    if not slots:
        slots, weights = [np.zeros(0, dtype=np.int32)], [np.zeros(0)]
    pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(slots)), pa.array(np.concatenate(weights))], names=["slot", "w"])
    return pa.ListArray.from_arrays(pa.array(np.array(ends, dtype=np.int32)), pairs)


def _vector_lists(rows: pa.Array, sums, dim: int) -> pa.Array:
    out = np.zeros((len(rows), dim), dtype=np.float32)
    for k, tokens in enumerate(_token_lists(rows)):
        v = np.zeros(dim)
        for slot, w in sums(tokens).items():
            v[slot] = w
        norm = np.sqrt((v * v).sum())
        out[k] = v / norm if norm > 0 else v
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dim), pa.array(out.ravel()))


def row_weights(df: DataFrame, key: str, text_col: str, dim: int, hasher: str) -> DataFrame:
    """``(key, _e array<struct<slot, w>>)`` for every input row: no shuffle."""
    make = _row_weights(dim, hasher)

    @F.arrow_udf("array<struct<slot:int,w:double>>")
    def weights(rows: pa.Array) -> pa.Array:
        return _weight_lists(rows, make())
    return df.select(F.col(key), weights(token_runs(text_col)).alias("_e"))


def vector_column(text: Column | str, dim: int, hasher: str = "blake2b") -> Column:
    """E01 as a column: ``array<float>[dim]`` of unit length (or zero) for a text; no shuffle, no key."""
    make = _row_weights(dim, hasher)

    @F.arrow_udf("array<float>")
    def vector(rows: pa.Array) -> pa.Array:
        return _vector_lists(rows, make(), dim)
    return vector(token_runs(text))


def row_vectors(df: DataFrame, key: str, text_col: str, dim: int, hasher: str) -> DataFrame:
    """``(key, embedding array<float>[dim])`` of unit length (or zero) for every input row: no shuffle."""
    return df.select(F.col(key), vector_column(text_col, dim, hasher).alias("embedding"))


def md5_slot(token: Column, dim: int) -> Column:
    h = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(dim)).cast("int")


def md5_sign(token: Column) -> Column:
    b = F.conv(F.substring(F.md5(token), 9, 2), 16, 10).cast("int")
    return F.when(b % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).cast("float")


def token_pairs(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """T06 exploded: one ``(key, token)`` row per token occurrence. The regex
    runs once per row: ``explode_outer`` yields a single NULL for a text
    without tokens, which becomes the ``empty`` token (the array form tests
    the size and so ran the regex twice inside the generator)."""
    return (df.select(F.col(key), F.explode_outer(token_runs(text_col)).alias("_t"))
            .select(F.col(key), F.coalesce(F.col("_t"), F.lit(EMPTY_TOKEN)).alias("token")))


def slot_weights(df: DataFrame, key: str = "uid", text_col: str = "description",
                 dim: int = 256, hasher: str = "blake2b") -> DataFrame:
    """Un-normalised signed slot sums ``(key, slot, w)``; every key keeps
    at least one row (a token always exists), even when all slots cancel.
    ``key`` must identify a row (see :func:`hash_embed` for rows that repeat it)."""
    if dim <= 0:
        raise ValueError("dim must be positive")
    if hasher == "md5":
        pairs = token_pairs(df, key, text_col)
        signed = pairs.select(key, md5_slot(F.col("token"), dim).alias("slot"),
                              md5_sign(F.col("token")).alias("sign"))
        return signed.groupBy(key, "slot").agg(F.sum(F.col("sign").cast("double")).alias("w"))
    return row_weights(df, key, text_col, dim, hasher).select(key, F.inline("_e"))


def _gathered(weights: DataFrame, key: str) -> DataFrame:
    """One row per key: its slot weights sorted by slot (at most ``dim``) and
    the L2 norm, both computed by the same aggregate (the norm is a plain
    column, never re-evaluated inside an array lambda)."""
    return weights.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col("slot").alias("k"), F.col("w").alias("v")))).alias("_e"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))


def sparse_from_weights(weights: DataFrame, key: str = "uid") -> DataFrame:
    """A12/M01 in long form: ``(key, slot, weight)``; a zero vector stays zero."""
    g = _gathered(weights, key)
    e = g.select(key, "_norm", F.explode("_e").alias("e"))
    return e.select(key, F.col("e.k").alias("slot"),
                    F.when(F.col("_norm") > 0, F.col("e.v") / F.col("_norm")).otherwise(F.lit(0.0))
                    .alias("weight"))


def hash_embed(df: DataFrame, key: str = "uid", text_col: str = "description", dim: int = 256,
               hasher: str = "blake2b") -> DataFrame:
    """``(key, embedding array<float>[dim], spec)`` for every input row;
    rows with an equal key stay apart, and nothing is shuffled."""
    model = HASH_MODEL_NAME if hasher == "blake2b" else f"{HASH_MODEL_NAME}-{hasher}"
    return row_vectors(df, key, text_col, dim, hasher).withColumn("spec", encoder_spec("hash", model, dim))


def _unit(v: Column, norm: Column) -> Column:
    """``v / norm`` per element, zero where the norm is. The norm is bound once
    per row: inside the element lambda it would be worked out per element."""
    bound = F.array(F.struct(norm.alias("n"), v.alias("v")))
    return F.transform(bound, lambda s: F.transform(
        s["v"], lambda x: F.when(s["n"] > 0, x.cast("double") / s["n"]).otherwise(F.lit(0.0))))[0]


def embed(df: DataFrame, backend: str = "hash", key: str = "uid", text_col: str = "description",
          dim: int = 256, model_name: str = HASH_MODEL_NAME, factory=None,
          batch_size: int = 64, max_length: int = 64) -> DataFrame:
    """Backend dispatch. ``hash`` runs :func:`hash_embed`; ``t5`` (any
    contextual model) runs a user-supplied ``factory`` through
    ``predict_batch_udf``: the model loads once per Python worker and sees
    Arrow batches of ``batch_size`` texts. The factory returns
    ``predict(texts: np.ndarray) -> np.ndarray[n, d]`` and owns tokenisation and
    masked mean pooling (A08). L07: it sees the first ``max_length`` words of a
    text, joined by a space; as a word is one token at least, they hold the
    first ``max_length`` tokens of any tokenizer that doesn't join words."""
    b = backend.lower()
    if b not in BACKENDS:
        raise ValueError(f"Unknown text encoder backend: {backend}")
    if b == "hash":
        return hash_embed(df, key, text_col, dim)
    if factory is None:
        raise ValueError("backend 't5' needs a model factory")
    from pyspark.ml.functions import predict_batch_udf
    udf = predict_batch_udf(factory, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    if max_length <= 0:
        raise ValueError("max_length must be positive")
    words = F.array_join(F.slice(split_words(text_col), 1, max_length), " ")
    return df.select(F.col(key), udf(words).alias("embedding"),
                     encoder_spec(b, model_name, dim).alias("spec"))


def long_vectors(df: DataFrame, key: str, vec_col: str = "embedding") -> DataFrame:
    """Dense array -> ``(key, dim, v)`` rows (V13-style flatten for vectors)."""
    return df.select(F.col(key), F.posexplode(vec_col).alias("dim", "v"))


def mean_pool(tokens: DataFrame, key: str, mask: Column | None = None,
              vec_col: str = "embedding") -> DataFrame:
    """Per key and dimension, ``sum(v*mask)/max(sum(mask),1)``
    (plain mean when ``mask`` is None). Long form: partial sums combine
    map-side, so a key holding a third of the rows is not gathered in one task."""
    m = (mask if mask is not None else F.lit(1)).cast("double")
    rows = tokens.select(F.col(key), m.alias("_m"), F.posexplode(vec_col).alias("dim", "v"))
    if mask is None:
        agg = F.avg(F.col("v").cast("double"))
    else:
        agg = F.sum(F.col("v").cast("double") * F.col("_m")) / F.greatest(F.sum("_m"), F.lit(1.0))
    return rows.groupBy(key, "dim").agg(agg.alias("value"))


def l2_normalise(df: DataFrame, vec_col: str = "embedding") -> Column:
    """A12/M01 on a dense array column, row-local (no shuffle): ``v/|v|``, zero stays zero."""
    v = F.col(vec_col)
    return _unit(v, F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))))
