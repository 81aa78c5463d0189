"""Run tables, registry lookup, warehouse sinks."""

import tempfile

import pytest
from pyspark.sql import functions as F

from shapeloom.operators import scoring as sc
from shapeloom.operators import training as tr
from shapeloom.sources import readers, writers


def test_run_tables_and_curves(spark):
    hist = spark.createDataFrame([(1, 8.1954, 0.5032), (2, 7.5, 0.45)],
                                 "epoch int, generator_loss double, discriminator_loss double")
    m = tr.metrics_frame(hist, "r1")
    assert {(r.step, r.key) for r in m.collect()} == {(0, "generator_loss"), (0, "discriminator_loss"),
                                                      (1, "generator_loss"), (1, "discriminator_loss")}
    curves = tr.loss_curves(m, "r1").collect()
    assert [c.step for c in curves] == [0, 1] and curves[0].generator_loss == 8.1954
    p = tr.params_frame(spark, "r1", {"epochs": 20, "lr": 2e-4})
    assert {r.key: r.value for r in p.collect()} == {"epochs": "20", "lr": "0.0002"}
    out = tempfile.mkdtemp(prefix="sl-runs-", dir="/tmp")
    for run in ("r1", "r2", "r2"):  # the second write of r2 replaces the first
        writers.append_rows(m.withColumn("run_id", F.lit(run)), f"{out}/run_metrics")
    assert spark.read.parquet(f"{out}/run_metrics").count() == 8
    writers.write_history(hist, f"{out}/history")
    assert spark.read.json(f"{out}/history").count() == 2


def test_registry_defaults_and_text_dim(spark):
    reg = tr.registry_row(spark, "m1", 16, 8, "hash", None, 42, "file:/tmp/x.pt")
    row = sc.runtime_config(reg, "m1").first()
    assert row.encoder_model_name == "google-t5/t5-base" and row.voxel_shape == [32, 32, 32]
    e = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "embedding array<float>")
    assert tr.text_dim(e) == 2
    with pytest.raises(ValueError):
        tr.text_dim(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "embedding array<float>"))


def test_minibatch_sizes(spark):
    df = spark.range(0, 10).withColumnRenamed("id", "uid")
    b = tr.minibatches(df, batch_size=4, seed=1, epochs=2).collect()
    sizes = {}
    for r in b:
        sizes[(r.epoch, r.batch)] = sizes.get((r.epoch, r.batch), 0) + 1
    assert sorted(sizes.values()) == [2, 2, 4, 4, 4, 4]  # last short batch kept
    again = tr.minibatches(df.repartition(3), batch_size=4, seed=1, epochs=2).collect()
    assert sorted(b) == sorted(again)
    big = tr.minibatches(df, batch_size=64, seed=1).collect()
    assert {r.batch for r in big} == {0}


def test_warehouse_sinks(spark):
    out = tempfile.mkdtemp(prefix="sl-wh-", dir="/tmp")
    df = spark.range(0, 5).select(F.col("id").cast("string").alias("uid"))
    df.write.parquet(f"{out}/raw.parquet")
    writers.load_table(spark, f"{out}/raw.parquet", "sl_raw_manifest")
    assert readers.read_table(spark, "sl_raw_manifest").count() == 5
    writers.materialize(df.limit(2), "sl_stage_view", "view")
    assert spark.table("sl_stage_view").count() == 2
    with pytest.raises(ValueError):
        writers.materialize(df, "x", "index")
