"""Tables laid out by key, splits, limits and truncation."""

import re
import tempfile
import uuid
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from __spark_entry__ import queries
from shapeloom.operators import catalog as cat
from shapeloom.operators import features as fe
from shapeloom.operators import training as tr
from shapeloom.operators import voxels as vx
from shapeloom.sources import readers, writers


def test_bucketed_tables_join_without_an_exchange(spark):
    ids = [f"u{k}" for k in range(50)]
    made = {"manifest": spark.createDataFrame([(u,) for u in ids], "uid string"),
            "cells": spark.createDataFrame([(u, 0, 0, k % 2, 1.0) for u in ids for k in range(2)], "uid string, x int, y int, z int, value float"),
            "embeddings": spark.createDataFrame([(u, [1.0, 2.0]) for u in ids], "uid string, embedding array<float>")}
    names = {n: writers.write_bucketed(df, f"b_{n}_{uuid.uuid4().hex[:8]}", buckets=4) for n, df in made.items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        view = tr.training_view(*[readers.read_table(spark, names[n]) for n in made], size=2, strict=False)
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
        plain = tr.training_view(*made.values(), size=2)
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, view.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keyed_files_are_read_for_requested_keys_alone(spark):
    rows = [(f"u{k}", k) for k in range(2000)] + [("u7", -7), (None, 0)]
    path = writers.write_keyed(spark.createDataFrame(rows, "uid string, n int"), tempfile.mkdtemp(prefix="sl-keyed-", dir="/tmp"), parts=32)
    some = spark.createDataFrame([("u7",), ("u7",), ("u900",), ("gone",), (None,)], "uid string")
    got = readers.read_keyed(spark, path, some, parts=32)
    assert sorted(map(tuple, got.collect())) == [("u7", -7), ("u7", 7), ("u900", 900)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    named = re.search(r"PartitionFilters: \[[^\]]*_part#\d+ IN \(([^)]*)\)", plan)  # folders that the scan opens
    assert 1 <= len(named[1].split(",")) <= 3
    assert readers.read_keyed(spark, path, some.limit(0), parts=32).isEmpty()


def test_splits_keep_groups_together(spark):
    df = spark.range(4000).selectExpr("id", "cast(id % 1500 AS string) AS g").unionByName(spark.createDataFrame([(-1, None), (-2, None)], "id long, g string"))
    shares = {"train": 8, "validation": 1, "test": 1}
    got = tr.split_rows(df, "g", shares).collect()
    assert all(len({r.split for r in got if r.g == g}) == 1 for g in ("0", "7", None))
    counts = Counter(r.split for r in got)
    assert 0.75 < counts["train"] / 4002 < 0.85 and set(counts) == set(shares)
    assert {(r.id, r.split) for r in tr.split_rows(df.repartition(7), "g", shares).collect()} == {(r.id, r.split) for r in got}
    assert {(r.id, r.split) for r in tr.split_rows(df, "g", shares, seed=1).collect()} != {(r.id, r.split) for r in got}
    assert {r.split for r in tr.split_rows(df, "g", {"all": 1.0}).collect()} == {"all"}
    with pytest.raises(ValueError):
        tr.split_rows(df, "g", {"a": -1.0, "b": 2.0})


def test_first_per_category(spark):
    rows = [(c, k) for c, n in (("hot", 500), ("two", 2)) for k in range(n)]
    got = cat.first_per_category(spark.createDataFrame(rows, "category string, n int").repartition(5), 3, ["n"])
    assert sorted(map(tuple, got.collect())) == [("hot", 0, 0), ("hot", 1, 1), ("hot", 2, 2), ("two", 0, 0), ("two", 1, 1)]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_models_see_the_first_words(spark):
    df = spark.createDataFrame([("a", "one two\nthree  four"), ("b", None), ("c", "x " * 100)], "uid string, description string")

    def factory():
        return lambda texts: np.array([[len(str(t).split()), len(str(t))] for t in texts], dtype=np.float32)
    got = {r.uid: r.embedding for r in fe.embed(df, "t5", factory=factory, max_length=3).collect()}
    assert got == {"a": [3, 13], "b": [0, 0], "c": [3, 5]}
    with pytest.raises(ValueError):
        fe.embed(df, "t5", factory=factory, max_length=0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_of_assets_laid_out_by_key_are_not_sent(spark):
    """From the explode of an asset's cells up to what is asked of them there is no exchange."""
    made = queries()
    faces = _plan(made["surface_faces"](spark, SF_SMALL))
    assert "Exchange" not in faces[:faces.rindex("Generate")]
    view = _plan(made["training_view"](spark, SF_SMALL))
    grids = view[view.index("ObjectHashAggregate"):]
    assert "Exchange" not in grids[:grids.index("Generate")]


def test_a_keys_rows_are_in_one_task(spark):
    df = spark.createDataFrame([(f"u{k % 7}", k) for k in range(90)] + [(None, 0), (None, 1)], "uid string, n int")
    got = vx.by_key(df, rows=5).withColumn("p", F.spark_partition_id())
    assert got.rdd.getNumPartitions() == 19 and got.count() == 92
    assert got.select("uid", "p").distinct().count() == 8


def test_cells_of_grids_laid_out_by_key_are_not_sent(spark):
    """Surfaces of grids: what a cell is joined and grouped with is found where the grid's cells were made."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name, limit in (("dual_vertices", "-1"), ("dual_vertices", before), ("dual_triangles", "-1"), ("dual_triangles", before)):
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            plan = _plan(queries()[name](spark, SF_SMALL)).splitlines()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        sent = [line for line in plan if "Exchange" in line and "ReusedExchange" not in line]
        assert sent and all("REPARTITION_BY_NUM" in line for line in sent)
        assert not any("Generate" in line for line in plan[plan.index(sent[-1]):])
