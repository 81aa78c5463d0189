"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import run_dir, written


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from every node that has an edge.

    Large-star and small-star steps in turn until the edges stay the same. A
    hub's minimum is an aggregate that combines before the shuffle, and going
    back to its neighbours is a join, which Spark can split; no neighbour list
    is ever held in one place. Each step is a written table. Nulls and loops
    are no edges; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    folder = run_dir(spark, "components")
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = written(e, folder, "e0")
    state, step = _fingerprint(e), 0
    while state[0]:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step += 1
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), folder, f"e{step}")
        before, state = state, _fingerprint(e)
        if state == before:
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select("v", "v").distinct())
