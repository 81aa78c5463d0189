"""Measures of generated shapes and embeddings."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table_dir
from .voxels import AXES, column_masks


# ----------------------------------------------------------------- R02
def voxel_iou(predicted: DataFrame, target: DataFrame, key: str = "uid", uids: DataFrame | None = None) -> DataFrame:
    """``(key, n_both, n_either, iou)`` of two tables of occupied cells.

    Cells are packed into masks along z first, so one full join of blocks and
    popcounts do; cells that repeat count once. ``iou`` is null where neither
    has a cell, which only keys named in ``uids`` can show.
    """
    a = column_masks(predicted, key).withColumnRenamed("m", "_a")
    b = column_masks(target, key).withColumnRenamed("m", "_b")
    none = F.lit(0).cast("long")
    j = a.join(b, [key, "x", "y", "zb"], "full").select(
        key, F.coalesce("_a", none).alias("_a"), F.coalesce("_b", none).alias("_b"))
    out = j.groupBy(key).agg(F.sum(F.bit_count(F.col("_a").bitwiseAND(F.col("_b"))).cast("long")).alias("n_both"),
                             F.sum(F.bit_count(F.col("_a").bitwiseOR(F.col("_b"))).cast("long")).alias("n_either"))
    if uids is not None:
        out = uids.select(key).distinct().join(out, key, "left").fillna(0, ["n_both", "n_either"])
    return out.withColumn("iou", F.when(F.col("n_either") > 0, F.col("n_both") / F.col("n_either")))


# ----------------------------------------------------------------- R05
def seed_diversity(cells: DataFrame, prompt: str = "prompt_id", seed: str = "seed", grids: DataFrame | None = None) -> DataFrame:
    """``(prompt, n_seeds, both, either, diversity)``: 1 - the IoU pooled over all pairs of a prompt's grids.

    A cell that m of the grids hold is in the intersection of m*(m-1)/2 pairs,
    so counts per cell give the sum over pairs without forming one. ``grids``
    names all (prompt, seed), those without cells too. Null for a prompt of one
    seed, or whose grids are all empty.
    """
    each = cells.select(prompt, seed, *[F.col(a).cast("int").alias(a) for a in AXES]).distinct()
    per_cell = each.groupBy(prompt, *AXES).agg(F.count(F.lit(1)).alias("m"))
    sums = per_cell.groupBy(prompt).agg(F.sum("m").alias("cells"), F.sum((F.col("m") * (F.col("m") - 1) / 2).cast("long")).alias("both"))
    seeds = (cells if grids is None else grids).select(prompt, seed).distinct().groupBy(prompt).agg(F.count(F.lit(1)).alias("n_seeds"))
    out = seeds.join(sums, prompt, "left").fillna(0, ["cells", "both"])
    out = out.withColumn("either", (F.col("n_seeds") - 1) * F.col("cells") - F.col("both"))
    return out.select(prompt, "n_seeds", "both", "either", F.when(
        F.col("either") > 0, 1 - F.col("both") / F.col("either")).alias("diversity"))


# ----------------------------------------------------------------- R03

#: Cells along a block's side: a target goes to (1 + 2 / BLOCK_CELLS) ** 3 blocks on average.
BLOCK_CELLS = 2


def _kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def nearest_distances(sources: DataFrame, targets: DataFrame, pairs: DataFrame, key: str = "uid") -> DataFrame:
    """``(src, dst, x, y, z, n, d)``: for every distinct point of cloud ``src`` (``n`` times there) its distance to cloud ``dst``.

    ``pairs`` has ``src, dst``. The target's points stand in a uniform grid of
    about one point a cell, and cells in blocks of BLOCK_CELLS a side. A
    source point goes to its own block, a target point to every block that
    has a cell next to its own, so that the least distance is found where
    they meet. What lies within a cell's side is nearest for certain; points
    that find nothing so near look again with cells twice as wide, so the
    rounds are as many as the farthest point needs. They are few by then, so
    they go to the blocks around them and the targets stay in their own.
    """
    spark = sources.sparkSession
    folder = scratch_table_dir(spark, f"nearest-{uuid.uuid4().hex}")
    points = lambda df: df.select(key, *[F.col(a).cast("double").alias(a) for a in AXES]).dropna()
    goal = points(targets).distinct().withColumnRenamed(key, "dst")
    side = goal.groupBy("dst").agg(
        F.greatest(*[F.max(a) - F.min(a) for a in AXES]).alias("extent"), F.count(F.lit(1)).alias("k"))
    side = side.select("dst", F.when(F.col("extent") > 0, F.col("extent") / F.ceil(F.cbrt("k"))).otherwise(F.lit(1.0)).alias("side"))
    goal = _kept(goal.join(side, "dst"), folder, "targets")
    left = points(sources).groupBy(key, *AXES).agg(F.count(F.lit(1)).alias("n")).withColumnRenamed(key, "src")
    left = left.join(pairs.select("src", "dst").distinct(), "src").join(side, "dst")
    squares = sum(((F.col(a) - F.col(f"t{a}")) * (F.col(a) - F.col(f"t{a}")) for a in AXES[1:]),
                  (F.col("x") - F.col("tx")) * (F.col("x") - F.col("tx")))
    block = [f"b{a}" for a in AXES]
    points_of, done = left.columns, []
    while not done or not left.isEmpty():
        width = F.col("side") * F.lit(float(2 ** len(done)))
        cell = {a: F.floor(F.col(a) / width) for a in AXES}
        own = lambda df, cell=cell: df.withColumns({f"b{a}": F.floor(c / BLOCK_CELLS) for a, c in cell.items()})

        def around(df, cell=cell):
            for a, c in cell.items():
                df = df.withColumn(f"b{a}", F.explode(F.sequence(F.floor((c - 1) / BLOCK_CELLS), F.floor((c + 1) / BLOCK_CELLS))))
            return df
        at, held = (around(left), own(goal)) if done else (own(left), around(goal))
        held = held.select(F.col("dst").alias("to"), *[F.col(b).alias(f"t{b}") for b in block], *[F.col(a).alias(f"t{a}") for a in AXES])
        # the rounding of a square is far below the slack; the root decides
        close = squares <= width * width * F.lit(1 + 1e-9)
        # merged: a broadcast would leave the first round to the few tasks that hold the sources
        met = at.join(held.hint("merge"), reduce(and_, [F.col(b) == F.col(f"t{b}") for b in block], F.col("dst") == F.col("to")) & close, "left")
        best = met.groupBy(*points_of, *([] if done else block)).agg(F.sqrt(F.min(squares)).alias("d"))
        best = _kept(best.select(*points_of, F.when(F.col("d") <= width, F.col("d")).alias("d")), folder, f"round-{len(done)}")
        done.append(best.where("d is not null"))
        left = best.where("d is null").drop("d")
    out = reduce(DataFrame.unionByName, done)
    return out.select("src", "dst", *AXES, "n", "d")


def chamfer(points: DataFrame, pairs: DataFrame, key: str = "uid") -> DataFrame:
    """``(a, b, a_to_b, b_to_a, chamfer)`` for each pair of clouds: mean nearest distances and their sum.

    A pair with a cloud that has no points is left out; repeated points count
    as often as they stand in the source. Points with a null coordinate are none.
    """
    clouds = points.select(key).distinct()
    wanted = pairs.select("a", "b").distinct().join(clouds.withColumnRenamed(key, "a"), "a", "left_semi").join(
        clouds.withColumnRenamed(key, "b"), "b", "left_semi")
    ways = wanted.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        wanted.select(F.col("b").alias("src"), F.col("a").alias("dst"))).distinct()
    means = nearest_distances(points, points, ways, key).groupBy("src", "dst").agg(
        (F.sum(F.col("d") * F.col("n")) / F.sum("n")).alias("m"))
    there = means.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("m").alias("a_to_b"))
    back = means.select(F.col("src").alias("b"), F.col("dst").alias("a"), F.col("m").alias("b_to_a"))
    return wanted.join(there, ["a", "b"]).join(back, ["a", "b"]).withColumn("chamfer", F.col("a_to_b") + F.col("b_to_a"))


# ----------------------------------------------------------------- R04
def top_matches(queries: DataFrame, corpus: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
                block_rows: int = 4096, digits: int = 9) -> DataFrame:
    """``(query, rank, match, score)``: the k rows of the corpus nearest to each query by cosine, itself left out.

    Exact. Both sides are packed into blocks of about ``block_rows`` rows by a
    hash of the key; each pair of blocks is one matrix product in a task, which
    keeps k rows a query; Spark's limited ranking merges them. Scores are
    rounded to ``digits`` and equal ones ranked by key. Null vectors, those with
    null or non-finite entries and zero vectors match nothing and ask nothing;
    vectors of unlike length don't meet. Keys are not null and identify a row.
    """
    def packed(df: DataFrame, block: str, names: tuple[str, str]) -> tuple[DataFrame, int]:
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
            F.col("id").isNotNull() & F.col("v").isNotNull()
            & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("v", lambda c: c != 0))
        n = max(1, -(-rows.count() // block_rows))
        blocks = rows.groupBy(F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(n)).alias(block)).agg(
            F.collect_list(F.struct("id", "v")).alias("_r"))  # block_rows, about
        return blocks.select("dim", block, F.col("_r.id").alias(names[0]), F.col("_r.v").alias(names[1])), n
    asked, n_asked = packed(queries, "qb", ("q", "qv"))
    held, _ = packed(corpus, "cb", ("c", "cv"))
    # every block of the corpus meets every block of queries: one row a pair of blocks
    met = held.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_asked - 1).cast("long")))).join(asked, ["dim", "qb"])
    met = met.repartition("cb", "qb")

    def unit(column: pa.Scalar) -> np.ndarray:
        m = np.array(column.as_py(), dtype=np.float64)
        return m / np.sqrt((m * m).sum(axis=1, keepdims=True))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                q, c = (np.array(batch.column(n)[row].as_py(), dtype=np.int64) for n in ("q", "c"))
                scores = np.round(unit(batch.column("qv")[row]) @ unit(batch.column("cv")[row]).T, digits)
                scores[q[:, None] == c[None, :]] = -np.inf
                by_key = np.argsort(c, kind="stable")
                order = by_key[np.argsort(-scores[:, by_key], axis=1, kind="stable")[:, :k]]
                best = np.take_along_axis(scores, order, axis=1)
                real = np.isfinite(best)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q, real.sum(axis=1))), pa.array(c[order][real]), pa.array(best[real])],
                    names=["query", "match", "score"])
    some = met.select("q", "qv", "c", "cv").mapInArrow(run, "query bigint, match bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "match"))
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "match", "score")


def retrieval_metrics(matches: DataFrame, labels: DataFrame, key: str = "vec_id", label: str = "label") -> DataFrame:
    """One row: n_queries, recall (share of queries with a match of their label), mrr (mean of 1 / its first rank, else 0)."""
    own = labels.select(F.col(key).alias("query"), F.col(label).alias("_own"))
    other = labels.select(F.col(key).alias("match"), F.col(label).alias("_other"))
    hit = F.min(F.when(F.col("_own") == F.col("_other"), F.col("rank")))
    first = matches.join(own, "query").join(other, "match").groupBy("query").agg(hit.alias("first"))
    return first.agg(F.count(F.lit(1)).alias("n_queries"), F.avg(F.col("first").isNotNull().cast("double")).alias("recall"),
                     F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))).alias("mrr"))


# ----------------------------------------------------------------- R06
def compare_runs(run_metrics: DataFrame, key: str, lower_is_better: bool = True) -> DataFrame:
    """``(run_id, n_steps, best_step, best, last, place)`` of one metric; the earliest of equal steps is the best.

    NaN and null values are no step. ``place`` ranks the runs by their best
    value, equal ones alike (one row a run).
    """
    m = run_metrics.where((F.col("key") == key) & F.col("value").isNotNull() & ~F.isnan("value"))
    order = F.struct((F.col("value") if lower_is_better else -F.col("value")).alias("v"), "step")
    runs = m.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_steps"), F.min_by("step", order).alias("best_step"), F.min_by("value", order).alias("best"),
        F.max_by("value", "step").alias("last"))
    best = F.col("best") if lower_is_better else -F.col("best")
    return runs.withColumn("place", F.rank().over(Window.orderBy(best)))


def artifact_rows(run_id: str, files: DataFrame, kind: str) -> DataFrame:
    """``run_artifacts(run_id, kind, file, bytes, sha256)`` of a manifest such as ``writers.publish_meshes`` returns."""
    return files.select(F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), "file", "bytes", "sha256")
