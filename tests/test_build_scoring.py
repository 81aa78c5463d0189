"""Build split invariants, prompt scoring and mesh export."""

import glob
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom import schemas
from shapeloom.operators import scoring as sc
from shapeloom.plans.build import build_catalog_dataset, build_synthetic_dataset
from shapeloom.sources import readers, writers

TRI = "uid string, fid int, ax double, ay double, az double, bx double, by double, bz double, cx double, cy double, cz double"


def _fixture(spark):
    idx = spark.createDataFrame([("chair", ["u1", "u2", "u3", "u4", "u5", "u1"], 0)], schemas.CATEGORY_INDEX)
    ann = spark.createDataFrame([("u1", "Oak chair", None, None, None), ("u2", "Red chair", None, None, None),
                                 ("u3", "Blue chair", None, None, None), ("u5", "!!!", "...", None, None)],
                                schemas.ANNOTATIONS)
    files = spark.createDataFrame([("u1", "/m/u1.glb"), ("u2", ""), ("u3", "/m/u3.glb"), ("u4", "/m/u4.glb")],
                                  schemas.ASSET_FILES)
    tris = spark.createDataFrame([("u1", 0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0),
                                  ("u1", 1, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0),
                                  ("u3", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], TRI)
    return idx, ann, files, tris


def test_catalog_build_split_invariant(spark):
    idx, ann, files, tris = _fixture(spark)
    out = tempfile.mkdtemp(prefix="sl-build-", dir="/tmp")
    res = build_catalog_dataset(idx, ann, files, tris, categories=["chair"], output_dir=out, dim=16)
    ok = {r.uid for r in res.manifest.collect()}
    bad = {r.uid: r.reason for r in res.failures.collect()}
    assert ok == {"u1"}
    assert bad == {"u2": "download_missing", "u3": "ValueError: Degenerate mesh: /m/u3.glb",
                   "u4": "ValueError: Empty mesh: /m/u4.glb", "u5": "download_missing"}
    assert ok.isdisjoint(bad)  # U04: success and failure partition the cleaned assets
    m = readers.read_manifest(spark, f"{out}/training_manifest.parquet")
    assert m.count() == 1 and glob.glob(f"{out}/failed_assets.csv/*.csv")
    assert res.cells.count() > 0 and len(res.embeddings.first().embedding) == 16


def test_zero_success_keeps_failure_log(spark):
    idx, ann, files, tris = _fixture(spark)
    out = tempfile.mkdtemp(prefix="sl-build-", dir="/tmp")
    with pytest.raises(RuntimeError, match="zero valid assets"):
        build_catalog_dataset(idx, ann, files.where("uid <> 'u1'"), tris, output_dir=out, dim=8)
    assert spark.read.parquet(f"{out}/failed_assets.parquet").count() == 5


def test_synthetic_build_and_manifest_formats(spark):
    out = tempfile.mkdtemp(prefix="sl-syn-", dir="/tmp")
    res = build_synthetic_dataset(spark.range(0, 6), output_dir=out, dim=64)
    assert res.manifest.count() == 6 and res.cells.select("uid").distinct().count() == 6
    with pytest.raises(ValueError, match="Unsupported manifest format: .json"):
        readers.read_manifest(spark, f"{out}/x.json")
    p = writers.write_manifest(res.manifest, out, stem="m2", fmt="csv")
    assert readers.read_manifest(spark, p).count() == 6


def test_prompt_validation_rules(spark):
    rows = [("p1", "a cube", 1, 0.5), ("p2", "x" * 301, 1, 0.5), ("p3", "   ", 1, 0.5), ("p4", "ok", None, 0.0),
            ("p5", "ok", None, 1.0), ("p6", "", None, 0.5), ("p7", "ok", None, None)]
    df = spark.createDataFrame(rows, schemas.PROMPTS)
    got = {r.prompt_id: r.reason for r in sc.validate_prompts(df).collect()}
    assert got["p1"] is None and got["p7"] is None
    assert "at most 300" in got["p2"] and got["p3"] == "Prompt must not be empty"
    assert "greater than 0" in got["p4"] and "less than 1" in got["p5"] and "at least 1" in got["p6"]


def test_seeded_noise_is_deterministic_and_normal(spark):
    df = spark.range(0, 400).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("s"))
    a = np.array([r.n for r in df.select(sc.seeded_noise(F.col("k"), F.col("s"), 16).alias("n")).collect()])
    b = np.array([r.n for r in df.repartition(5).orderBy("k").select(
        sc.seeded_noise(F.col("k"), F.col("s"), 16).alias("n")).collect()])
    assert a.shape == (400, 16) and abs(a.mean()) < 0.05 and abs(a.std() - 1) < 0.05
    assert np.array_equal(np.sort(a, axis=None), np.sort(b, axis=None))
    # like a seeded generator, the same seed gives the same noise whatever the prompt
    same = spark.createDataFrame([("x", 3), ("y", 3)], "k string, s int")
    r = same.select(sc.seeded_noise(F.col("k"), F.col("s"), 4).alias("n")).collect()
    assert r[0].n == r[1].n


def test_score_prompts_and_obj_export(spark):
    def factory():
        def predict(x):
            g = np.zeros((x.shape[0], 32 ** 3), dtype=np.float32)
            g[:, 16 * 1024 + 16 * 32 + 16] = 0.9  # one occupied cell per prompt
            return g
        return predict

    prompts = spark.createDataFrame([("p1", "a cube", 1, 0.5), ("p2", " ", 2, 0.5)], schemas.PROMPTS)
    cells, rejects = sc.score_prompts(prompts, factory, text_dim=8, noise_dim=4)
    assert [r.prompt_id for r in rejects.collect()] == ["p2"]
    assert cells.count() == 1
    verts, tris = sc.surface_mesh(cells, 0.5)
    assert verts.count() == 8 and tris.count() == 12
    out = tempfile.mkdtemp(prefix="sl-obj-", dir="/tmp")
    writers.write_obj(verts, tris, out)
    files = glob.glob(f"{out}/uid=p1/*.txt")
    lines = open(files[0]).read().splitlines()
    assert sum(ln.startswith("v ") for ln in lines) == 8 and sum(ln.startswith("f ") for ln in lines) == 12
    assert lines[0].startswith("v ") and lines[-1].startswith("f ")


def test_score_prompts_keeps_empty_grids_and_thresholds(spark):
    def factory():
        return lambda x: np.zeros((x.shape[0], 8), dtype=np.float32)
    prompts = spark.createDataFrame([("p1", "a cube", 1, 0.25)], schemas.PROMPTS)
    cells, _ = sc.score_prompts(prompts, factory, text_dim=8, noise_dim=4, size=2)
    assert [(r.uid, r.x, r.y, r.z, r.value, r.threshold) for r in cells.collect()] == [("p1", 0, 0, 0, 0.0, 0.25)]


def test_mesh_lookup_basename(spark):
    req = spark.createDataFrame([("../../a.obj",), ("b.obj",)], "filename string")
    inv = spark.createDataFrame([("a.obj",)], "filename string")
    got = {r.request: (r.safe_name, r.found) for r in sc.mesh_lookup(req, inv).collect()}
    assert got == {"../../a.obj": ("a.obj", True), "b.obj": ("b.obj", False)}


def test_asset_inventory(spark):
    root = tempfile.mkdtemp(prefix="sl-inv-", dir="/tmp")
    os.makedirs(f"{root}/000-001")
    for n in ("abc.glb", "skip.GLB", "000-001/def.glb"):
        open(f"{root}/{n}", "wb").write(b"x")
    inv = readers.asset_inventory(spark, root)
    assert sorted(r.uid for r in inv.collect()) == ["abc", "def"]


def test_manifest_columns_go_by_name_and_missing_ones_are_reported(spark, tmp_path):
    from shapeloom.operators import quality as q
    whole = spark.createDataFrame([("s", "e/1", "u1", "v/1", "text", "chair")],
                                  "source string, embedding_path string, uid string, voxel_path string, description string, category string")
    whole.write.option("header", True).csv(str(tmp_path / "m.csv"))
    row = readers.read_manifest(spark, str(tmp_path / "m.csv")).first()
    assert (row.uid, row.embedding_path, row.voxel_path, row.source) == ("u1", "e/1", "v/1", "s")
    whole.drop("voxel_path").write.parquet(str(tmp_path / "m.parquet"))
    with pytest.raises(ValueError, match="voxel_path"):
        q.check_manifest(readers.read_manifest(spark, str(tmp_path / "m.parquet")))


def test_strict_training_view_wants_grids(spark):
    from shapeloom.operators import training as tr
    man = spark.createDataFrame([("a",), ("b",)], "uid string")
    cells = spark.createDataFrame([("a", 0, 0, 0, 1.0)], "uid string, x int, y int, z int, value float")
    emb = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "uid string, embedding array<float>")
    with pytest.raises(ValueError, match="voxel grid"):
        tr.training_view(man, cells, emb, size=2)
    empty = spark.createDataFrame([("b",)], "uid string")
    assert tr.training_view(man, cells, emb, size=2, empty_grids=empty).count() == 2
