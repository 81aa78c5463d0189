"""Training-data operators: training view, mini-batches, loss metrics, run tables.

X01-X06, X11, J03, W04, L08, A06, A07, M06, P09, K08-K10.
The gradient step itself is model code and is not part of the engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.ordinal import ordinal_within
from ..operators.voxels import dense_entries, densify


def training_view(manifest: DataFrame, cells: DataFrame, embeddings: DataFrame,
                  size: int = 32, strict: bool = True, key: str = "uid",
                  empty_grids: DataFrame | None = None) -> DataFrame:
    """``(uid, voxels array<float>[size^3], embedding)`` per manifest row.

    Two equi-joins on ``uid``, each table read once; over tables that
    ``writers.write_bucketed`` laid out by ``uid`` neither needs an exchange.
    In strict mode a manifest row without a voxel
    grid or embedding is an error (the check is two anti-join counts). An asset
    whose grid has no occupied cell has no row in ``cells``: ``empty_grids``
    names those, and they get an all-zero grid (V08).
    """
    m = manifest.select(key).where(F.col(key).isNotNull())
    if strict:
        no_emb = m.join(embeddings.select(key), key, "left_anti").limit(1).count()
        if no_emb:
            raise ValueError("manifest rows without an embedding")
        have = cells.select(key)
        if empty_grids is not None:
            have = have.unionByName(empty_grids.select(key))
        if m.join(have.distinct(), key, "left_anti").limit(1).count():
            raise ValueError("manifest rows without a voxel grid")
    # grids stay sparse (occupied cells only) through both joins and are
    # densified last: a join side never carries size^3 floats per row, which
    # the planner's size estimate for a UDF's array output would not see
    grids = dense_entries(cells.join(m, key, "left_semi"), size, key)
    # merged, since the planner takes a list for one entry and might broadcast all grids
    v = m.join(embeddings.select(key, "embedding"), key).join(grids.hint("merge"), key, "left")
    # An asset with no occupied cell has NULL entries -> an all-zero grid
    return v.select(key, densify(F.col("_e"), size).alias("voxels"), "embedding")


def text_dim(embeddings: DataFrame, vec_col: str = "embedding") -> int:
    """The embedding width; all rows must agree."""
    r = embeddings.agg(F.min(F.size(vec_col)).alias("lo"), F.max(F.size(vec_col)).alias("hi")).first()
    if r is None or r["lo"] is None:
        raise ValueError("no embeddings")
    if r["lo"] != r["hi"]:
        raise ValueError(f"embedding widths differ: {r['lo']}..{r['hi']}")
    return int(r["lo"])


def shuffle_key(key: str | Column, seed: int, epoch: int | Column, hasher: str = "xxhash64") -> Column:
    """Reproducible shuffle order, independent of partitioning."""
    k = F.col(key) if isinstance(key, str) else key
    e = epoch if isinstance(epoch, Column) else F.lit(int(epoch))
    if hasher == "md5":
        return F.md5(F.concat_ws(":", k.cast("string"), F.lit(str(seed)), e.cast("string")))
    return F.xxhash64(k, F.lit(int(seed)), e)


def minibatches(df: DataFrame, batch_size: int, seed: int = 42, epochs: int = 1, key: str = "uid",
                hasher: str = "xxhash64", n_rows: int | None = None) -> DataFrame:
    """``(epoch, key, rn, batch)`` for every row and epoch 1..epochs.

    Order within an epoch is a hash of ``(key, seed, epoch)``; ``rn`` is the
    dense position (range-partitioned ordinals, no single-partition window);
    ``batch = (rn-1) // min(batch_size, n)``, the last short batch is kept.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    n = n_rows if n_rows is not None else df.count()
    b = max(1, min(batch_size, n))
    ep = df.select(F.col(key), F.explode(F.sequence(F.lit(1), F.lit(int(epochs)))).alias("epoch"))
    ep = ep.withColumn("_k", shuffle_key(key, seed, F.col("epoch"), hasher))
    ranked = ordinal_within(ep, ["epoch"], ["_k", key], out="rn", start=1)
    return ranked.select("epoch", key, "rn", ((F.col("rn") - 1) / b).cast("long").alias("batch"))


def sigmoid(x: Column) -> Column:
    """M06."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def bce(y: Column, p: Column) -> Column:
    """Binary cross-entropy of one prediction, logs clamped at -100 like the
    training criterion (``ln 0`` is NULL in Spark and ``greatest`` skips it)."""
    lp = F.greatest(F.log(p), F.lit(-100.0))
    lq = F.greatest(F.log(F.lit(1.0) - p), F.lit(-100.0))
    return -(y * lp + (F.lit(1.0) - y) * lq)


def log_loss(scored: DataFrame, group: list[str], label: str = "label", p: str = "p") -> DataFrame:
    """Mean BCE per group."""
    return scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(bce(F.col(label).cast("double"), F.col(p).cast("double"))).alias("log_loss"))


def epoch_metrics(batch_losses: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Per epoch, the *unweighted mean of batch means*."""
    keys = [c for c in (run_col,) if c in batch_losses.columns] + ["epoch"]
    return batch_losses.groupBy(*keys).agg(
        F.avg("generator_loss").alias("generator_loss"),
        F.avg("discriminator_loss").alias("discriminator_loss"),
        F.count(F.lit(1)).alias("batches"))


def batch_means(rows: DataFrame, loss_cols: list[str], keys=("epoch", "batch")) -> DataFrame:
    """Mean of per-row losses per mini-batch (the input of :func:`epoch_metrics`)."""
    return rows.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in loss_cols])


# ---- run tracking tables (K08/K09/K10/X06): small driver-side records ------

def params_frame(spark: SparkSession, run_id: str, params: Mapping[str, object]) -> DataFrame:
    rows = [(run_id, str(k), str(v)) for k, v in sorted(params.items())]
    return spark.createDataFrame(rows, schemas.RUN_PARAMS)


def metrics_frame(history: DataFrame, run_id: str) -> DataFrame:
    """Epoch metrics -> long ``run_metrics(run_id, step, key, value)``; step = epoch-1."""
    cols = ["generator_loss", "discriminator_loss"]
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value"))
                             for c in cols])).alias("kv")
    return history.select(F.lit(run_id).alias("run_id"), (F.col("epoch") - 1).cast("int").alias("step"), st) \
        .select("run_id", "step", "kv.key", "kv.value")


def registry_row(spark: SparkSession, model_id: str, text_dim_: int, noise_dim: int,
                 encoder_backend: str, encoder_model_name: str | None, seed: int, uri: str,
                 voxel_shape=(32, 32, 32)) -> DataFrame:
    """Checkpoint metadata as one ``model_registry`` row (weights stay at ``uri``)."""
    return spark.createDataFrame([(model_id, int(text_dim_), int(noise_dim), encoder_backend,
                                   encoder_model_name, list(voxel_shape), int(seed), uri)],
                                 schemas.MODEL_REGISTRY)


def loss_curves(run_metrics: DataFrame, run_id: str | None = None) -> DataFrame:
    """X11: ordered per-step losses of a run (the data behind the plots)."""
    m = run_metrics if run_id is None else run_metrics.where(F.col("run_id") == run_id)
    return m.groupBy("run_id", "step").pivot("key", ["generator_loss", "discriminator_loss"]) \
        .agg(F.first("value")).orderBy("run_id", "step")


def split_rows(df: DataFrame, group: str | Column, shares: Mapping[str, float], seed: int = 42, out: str = "split") -> DataFrame:
    """``df`` with the split of each row: ``shares`` name the splits and their parts of the whole.

    A row's place is a function of ``seed`` and its group alone (the first 32
    bits of an md5), so copies of a group never part, reruns and other
    partitionings agree, and a larger table keeps earlier rows where they
    were. Null groups are one group. No shuffle.
    """
    total = float(sum(shares.values()))
    if not shares or total <= 0 or min(shares.values()) < 0:
        raise ValueError("shares must not be negative, and some must be positive")
    g = F.col(group) if isinstance(group, str) else group
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(g.cast("string"), F.lit(""))))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
    split, upto = None, 0.0
    for name, share in list(shares.items())[:-1]:
        upto += share / total
        split = F.when(place < upto, name) if split is None else split.when(place < upto, name)
    last = F.lit(list(shares)[-1])
    return df.withColumn(out, last if split is None else split.otherwise(last))
