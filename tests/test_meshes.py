"""Closed surfaces, prompts to published meshes, guarded models, and the measures against brute force."""

import math
import os
import random
import tempfile
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom import schemas
from shapeloom.functions.guard import guarded
from shapeloom.operators import evaluate as ev
from shapeloom.operators import scoring as sc
from shapeloom.operators import surface as sf
from shapeloom.operators import training as tr
from shapeloom.operators import voxels as vx
from shapeloom.plans.build import build_catalog_dataset
from shapeloom.sources import writers

CELLS = "uid string, x int, y int, z int, value double"


def sides(triangles):
    out = Counter()
    for r in triangles:
        c = [(r[0], *(r[f"{p}{n}"] for n in sf.CUBE)) for p in "abc"]
        out.update(zip(c, c[1:] + c[:1]))
    return out


def volume(vertices, triangles, uid):
    at = {tuple(r[n] for n in sf.CUBE): np.array([r.x, r.y, r.z]) for r in vertices if r[0] == uid}
    total = 0.0
    for r in triangles:
        if r[0] == uid:
            a, b, c = (at[tuple(r[f"{p}{n}"] for n in sf.CUBE)] for p in "abc")
            total += a @ np.cross(b, c) / 6
    return total


def test_surface_is_closed_and_turned_outwards(spark):
    rng = np.random.default_rng(1)
    rows = [(u, x, y, z, float(v)) for u in "ab" for (x, y, z), v in np.ndenumerate(rng.random((4, 4, 140)))]
    rows += [("one", 3, 3, 3, 1.0)]
    r = 6.0
    rows += [("ball", x, y, z, max(0.0, 1.0 - math.dist((x, y, z), (8, 8, 8)) / (2 * r)))
             for x in range(17) for y in range(17) for z in range(17)]
    v, t = (d.collect() for d in sf.dual_surface(spark.createDataFrame(rows, CELLS), 0.5))
    used = sides(t)
    assert all(used[b, a] == n for (a, b), n in used.items())
    assert all(n == 1 for (a, _), n in used.items() if a[0] in ("one", "ball"))  # each side in two triangles
    assert {c for s in used for c in s} == {(x[0], x.i, x.j, x.k) for x in v}
    assert len([x for x in v if x[0] == "one"]) == 8 and volume(v, t, "one") > 0
    assert volume(v, t, "ball") == pytest.approx(4 / 3 * math.pi * r ** 3, rel=0.05)
    assert all(abs(math.dist((x.x, x.y, x.z), (8, 8, 8)) - r) < 0.5 for x in v if x[0] == "ball")


def test_surface_levels_by_column_and_none(spark):
    cells = spark.createDataFrame([("a", 0, 0, 0, 0.4), ("b", 0, 0, 0, 0.4), ("c", 5, 5, 5, -1.0), ("c", 5, 5, 6, -2.0)], CELLS)
    level = F.when(F.col("uid") == "a", 0.3).when(F.col("uid") == "c", -1.5).otherwise(0.5)
    v, t = sf.dual_surface(cells, level)
    assert dict(Counter(r.uid for r in v.collect())) == {"a": 8, "c": 8} and t.where("uid = 'b'").isEmpty()
    edges = {r.face: (r.px, r.py, r.pz) for r in sf.crossed_edges(cells, level).where("uid = 'c'").collect()}
    assert edges["+z"] == (5, 5, 5.5) and edges["-z"] == (5, 5, 4.5) and edges["+x"] == (5.5, 5, 5)


def test_crossed_edges_of_repeated_and_null_cells(spark):
    """Cells may stand twice, with equal or other values, or lack a key, a place or a value: as joins by key and place have it."""
    rng = random.Random(5)
    rows = [(u, rng.randrange(4), rng.randrange(3), rng.randrange(3), rng.choice([0.0, 0.25, 0.75, 1.0, None]))
            for u in ("a", "b") for _ in range(60)]
    rows += rows[:9] + [(None, 0, 0, 0, 1.0), ("a", None, 0, 0, 1.0), ("a", 0, 0, None, 0.0)]
    at = {}
    for u, x, y, z, v in rows:
        if None not in (u, x, y, z):
            at.setdefault((u, x, y, z), []).append(v)
    inside = {c for c, vs in at.items() if any(v is not None and v >= 0.5 for v in vs)}
    step = {"+x": (1, 0, 0), "-x": (-1, 0, 0), "+y": (0, 1, 0), "-y": (0, -1, 0), "+z": (0, 0, 1), "-z": (0, 0, -1)}
    want = Counter()
    for u, *p in inside:
        for face, d in step.items():
            n = tuple(a + b for a, b in zip(p, d))
            if (u, *n) not in inside:
                for v in at[u, *p]:
                    for b in at.get((u, *n), [None]):
                        b = b or 0.0
                        f = None if v is None or b == v else (0.5 - v) / (b - v)
                        at_face = [None if f is None else round(a + s * f, 9) + 0.0 for a, s in zip(p, d)]
                        want[u, *p, face, *map(min, p, n), *at_face] += 1
    mode = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")  # equal values of two cells at one place give no crossing point
        got = sf.crossed_edges(spark.createDataFrame(rows, CELLS), 0.5).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", mode)
    assert Counter((r.uid, r.x, r.y, r.z, r.face, r.ex, r.ey, r.ez,
                    *[None if c is None else round(c, 9) + 0.0 for c in (r.px, r.py, r.pz)]) for r in got) == want


def test_face_masks_equal_brute_force_at_block_borders(spark):
    rng = random.Random(2)
    some = {("a", rng.randrange(3), rng.randrange(3), rng.randrange(-5, 200)) for _ in range(900)}
    some |= {("b", 0, 0, z) for z in (-1, 0, 61, 62, 63, 123, 124)}
    got = {tuple(r) for r in vx.boundary_faces(spark.createDataFrame([(*c, 1.0) for c in some], CELLS)).collect()}
    step = {"+x": (1, 0, 0), "-x": (-1, 0, 0), "+y": (0, 1, 0), "-y": (0, -1, 0), "+z": (0, 0, 1), "-z": (0, 0, -1)}
    assert got == {(u, x, y, z, f) for u, x, y, z in some for f, (a, b, c) in step.items() if (u, x + a, y + b, z + c) not in some}


def test_guard_cuts_out_bad_rows(spark):
    calls = []

    def factory():
        def predict(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no " + next(t for t in texts if "bad" in t))
            return [np.array([len(t), np.inf if t == "inf" else 0.0], dtype=np.float32) for t in texts]
        return predict
    rows = [(k, t) for k, t in enumerate(["a", "bad 1", "bb", None, "inf", "ccc", "bad 2"] * 9)]
    df = spark.createDataFrame(rows, "k int, t string").coalesce(1)
    got = {r.k: r.g for r in df.select("k", guarded(factory, "array<float>", 4)("t").alias("g")).collect()}
    for k, t in rows:
        if t is None:
            assert got[k].value is None and got[k].reason is None
        elif "bad" in t:
            assert got[k].value is None and got[k].reason == f"RuntimeError: no {t}"
        elif t == "inf":
            assert got[k].value is None and "non-finite" in got[k].reason
        else:
            assert got[k].value == [len(t), 0.0] and got[k].reason is None
    short = df.select(guarded(lambda: lambda t: [1.0] * max(0, len(t) - 1), "double")("t").alias("g")).where("t is not null")
    assert {r.g.reason for r in short.collect()} == {"ValueError: 0 values for 1 rows"} and not calls


def test_build_loses_only_the_bad_rows(spark):
    index = spark.createDataFrame([("chair", ["u1", "u2", "u3"], 0)], schemas.CATEGORY_INDEX)
    notes = spark.createDataFrame([(u, n, None, None, None) for u, n in (("u1", "Oak chair"), ("u2", "Bad chair"), ("u3", "Red chair"))],
                                  schemas.ANNOTATIONS)
    files = spark.createDataFrame([(u, f"/m/{u}.glb") for u in ("u1", "u2", "u3")], schemas.ASSET_FILES)
    names = [f"{p}{a}" for p in "abc" for a in "xyz"]
    flat = [0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.5]
    tris = spark.createDataFrame([("u1", 0, *flat), ("u2", 0, *flat), ("u3", 0, float("nan"), *flat[1:])],
                                 "uid string, fid int, " + ", ".join(f"{n} double" for n in names))

    def encoder():
        def predict(texts):
            if any("bad" in t.lower() for t in texts):
                raise ValueError("cannot read")
            return [np.array([1.0, len(t)], dtype=np.float32) for t in texts]
        return predict
    made = build_catalog_dataset(index, notes, files, tris, dim=2, encoder=encoder)
    assert {r.uid for r in made.manifest.collect()} == {"u1"} == {r.uid for r in made.embeddings.collect()}
    assert {r.uid: r.reason for r in made.failures.collect()} == {
        "u2": "ValueError: cannot read", "u3": "ValueError: Non-finite mesh: /m/u3.glb"}


def _registry(spark, side=4, noise=3, backend="hash", name="signed-hash-md5"):
    return tr.registry_row(spark, "m", 8, noise, backend, name, 1, "", (side,) * 3).unionByName(
        tr.registry_row(spark, "other", 9, 0, "hash", None, 1, ""))


def _model_of():
    """A factory that workers can load: they don't see this module."""
    def model():
        def predict(x):
            out = np.zeros((len(x), 64), dtype=np.float32)
            out[:, 21] = 0.9
            out[:, 22] = np.abs(x[:, :8]).sum(axis=1) / 10
            return out
        return predict
    return model


def test_prompt_meshes_keep_every_row_and_publish_files(spark):
    rows = [("a", "red chair", 1, 0.5), ("a", "blue table", 1, 0.5), (None, "red chair", 1, 0.5), ("b", " ", 1, 0.5),
            ("c", "red chair", None, 0.5), ("c", "red chair", None, 0.5), (None, None, 1, 0.5), ("d", "x", 2, 0.95)]
    prompts = spark.createDataFrame(rows, schemas.PROMPTS)
    made = sc.prompt_meshes(prompts, _registry(spark), "m", {"m": _model_of()})
    got = made.requests.collect()
    assert Counter((r.prompt_id, r.prompt) for r in got) == Counter(r[:2] for r in rows)
    reasons = Counter(r.reason for r in got)
    assert reasons == {None: 6, "Prompt must not be empty": 1, "prompt: String should have at least 1 character": 1}
    assert all((r.filename is None) == (r.reason is not None) and (r.n_vertices > 0) == (r.reason is None) for r in got)
    assert next(r.level for r in got if r.prompt == "x") == pytest.approx(0.45)  # no value above 0.95: half of the range
    spans = made.vertices.groupBy("request").agg(F.greatest(*[F.max(a) - F.min(a) for a in "xyz"]).alias("s")).collect()
    assert len(spans) == 5 and all(r.s == pytest.approx(1.0) for r in spans)
    root = tempfile.mkdtemp(prefix="sl-mesh-", dir="/tmp")
    seen = []
    for _ in range(2):
        manifest = writers.publish_meshes(made.vertices, made.triangles, made.requests, root).collect()
        seen.append(sorted(map(tuple, manifest)))
        assert {f"/meshes/{r.filename}" for r in manifest} == {r.download_url for r in got if r.download_url}
        for r in manifest:
            lines = open(f"{root}/{r.file}").read().split("\n")
            assert sum(x.startswith("v ") for x in lines) == r.n_vertices and sum(x.startswith("f ") for x in lines) == r.n_triangles
            assert os.path.getsize(f"{root}/{r.file}") == r.bytes
            faces = [tuple(map(int, x.split()[1:])) for x in lines if x.startswith("f ")]
            assert {k for f in faces for k in f} == set(range(1, r.n_vertices + 1))
    assert seen[0] == seen[1] and not os.listdir(f"{root}/_open")
    art = ev.artifact_rows("run-1", spark.read.parquet(f"{root}/manifest"), "mesh").collect()
    assert len(art) == 5 and art[0].run_id == "run-1"
    twice = made.requests.withColumn("filename", F.lit("same.obj"))
    with pytest.raises(ValueError, match="share a filename"):
        writers.publish_meshes(made.vertices, made.triangles, twice, root)


def test_prompt_meshes_failing_models_and_settings(spark):
    prompts = spark.createDataFrame([(str(k), f"prompt {k}", k, 0.5) for k in range(6)], schemas.PROMPTS)

    def broken():
        def predict(x):
            grids = [np.full(64, 0.7, dtype=np.float32) for _ in x]
            for g, row in zip(grids, x):
                g[0] = np.nan if row.sum() > 1 else 0.2
            return grids
        return predict
    encoders = {"sizes": lambda: lambda texts: np.array([[float(t[-1])] * 8 for t in texts], dtype=np.float32)}
    made = sc.prompt_meshes(prompts, _registry(spark, noise=0, backend="t5", name="sizes"), "m", {"m": broken}, encoders).requests
    got = {r.prompt_id: r.reason for r in made.collect()}
    assert got["0"] is None and all("non-finite" in got[str(k)] for k in range(1, 6))
    flat = sc.prompt_meshes(prompts, _registry(spark), "m", {"m": lambda: lambda x: np.zeros((len(x), 64))}).requests
    assert {r.reason for r in flat.collect()} == {"Voxel grid has no isosurface"}
    wrong = sc.prompt_meshes(prompts, _registry(spark), "m", {"m": lambda: lambda x: np.zeros((len(x), 63))}).requests
    assert {r.reason for r in wrong.collect()} == {"ValueError: Expected a 3D voxel grid of 64 cells, got 63"}
    with pytest.raises(ValueError, match="no encoder"):
        sc.prompt_meshes(prompts, _registry(spark, backend="t5", name="gone"), "m", {"m": _model_of()})
    with pytest.raises(ValueError, match="0 registry rows"):
        sc.prompt_meshes(prompts, _registry(spark), "absent", {})
    assert sc.prompt_meshes(prompts.limit(0), _registry(spark), "m", {"m": _model_of()}).requests.isEmpty()


def test_score_prompts_by_row(spark):
    rows = [("a", "red chair", 1, 0.5), ("a", "blue table", 2, 0.5), (None, "red chair", 1, 0.5)]
    cells, _ = sc.score_prompts(spark.createDataFrame(rows, schemas.PROMPTS), lambda: lambda x: np.ones((len(x), 8), dtype=np.float32),
                                text_dim=8, noise_dim=4, size=2)
    assert Counter(r.uid for r in cells.collect()) == {"a": 16, None: 8}


def test_chamfer_equals_brute_force(spark):
    rng = random.Random(3)
    clouds = {"a": [tuple(rng.random() for _ in "xyz") for _ in range(60)], "b": [tuple(rng.gauss(0, 3) for _ in "xyz") for _ in range(40)],
              "far": [(500.0 + rng.random(), 0.0, 0.0) for _ in range(5)], "one": [(0.0, 0.0, 0.0)] * 3, "line": [(0.0, float(k), 0.0) for k in range(9)]}
    clouds["a"] += clouds["a"][:5]
    points = spark.createDataFrame([(u, *p) for u, ps in clouds.items() for p in ps] + [("a", None, 1.0, 1.0)], "uid string, x double, y double, z double")
    pairs = [(a, b) for a in clouds for b in clouds] + [("a", "none"), ("a", "b")]
    got = {(r.a, r.b): r.chamfer for r in ev.chamfer(points, spark.createDataFrame(pairs, "a string, b string")).collect()}
    mean = lambda a, b: sum(min(math.dist(p, q) for q in clouds[b]) for p in clouds[a]) / len(clouds[a])
    assert set(got) == {(a, b) for a in clouds for b in clouds}
    assert all(v == pytest.approx(mean(a, b) + mean(b, a), abs=1e-9) for (a, b), v in got.items())


def test_nearest_points_meet_in_blocks(spark, monkeypatch):
    """Exact over block borders and several rounds, and no source point is sent to all the cells around it."""
    rng = random.Random(6)
    clouds = {"p": [tuple(rng.uniform(-9, 9) for _ in "xyz") for _ in range(300)], "q": [tuple(rng.gauss(0, 2) for _ in "xyz") for _ in range(300)]}
    points = spark.createDataFrame([(u, *p) for u, ps in clouds.items() for p in ps], "uid string, x double, y double, z double")
    made, kept = [], ev._kept
    monkeypatch.setattr(ev, "_kept", lambda df, folder, name: made.append((name, df)) or kept(df, folder, name))
    ways = spark.createDataFrame([("p", "q"), ("q", "p"), ("p", "p")], "src string, dst string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = ev.nearest_distances(points, points, ways).collect()
        found = next(df for name, df in made if name == "round-0")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # both sides are laid out by block, and the least distance needs no exchange after the join
    assert "Exchange" not in plan[:plan.index("Join")]
    assert len(got) == 900
    for r in got:
        assert r.d == pytest.approx(min(math.dist((r.x, r.y, r.z), t) for t in clouds[r.dst]), abs=1e-12)


def test_iou_and_diversity_equal_brute_force(spark):
    rng = random.Random(4)
    grids = {(p, s): {tuple(rng.randrange(3) for _ in "xyz") + () for _ in range(rng.choice([0, 5, 20]))} for p in "pqr" for s in range(4)}
    grids["solo", 0] = {(1, 1, 100)}
    grids["void", 0] = grids["void", 1] = set()
    rows = [(p, s, *c) for (p, s), cells in grids.items() for c in cells] * 2
    cells = spark.createDataFrame(rows, "prompt_id string, seed int, x int, y int, z int")
    named = spark.createDataFrame(list(grids), "prompt_id string, seed int")
    for r in ev.seed_diversity(cells, grids=named).collect():
        own = [g for (p, _), g in grids.items() if p == r.prompt_id]
        both, either = (sum(len(f(a, b)) for a, b in combinations(own, 2)) for f in (set.__and__, set.__or__))
        assert (r.n_seeds, r.both, r.either) == (len(own), both, either)
        assert r.diversity == (pytest.approx(1 - both / either) if either else None)
    left, right = (cells.where(f"seed = {k}").withColumnRenamed("prompt_id", "uid") for k in (0, 1))
    got = ev.voxel_iou(left, right, uids=named.withColumnRenamed("prompt_id", "uid"))
    for r in got.collect():
        a, b = grids.get((r.uid, 0), set()), grids.get((r.uid, 1), set())
        assert (r.n_both, r.n_either) == (len(a & b), len(a | b))
        assert r.iou == (pytest.approx(len(a & b) / len(a | b)) if a | b else None)


def test_top_matches_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(v) for v in rng.integers(-2, 3, 4)]) for k in range(300)] + [(300, None), (301, [0.0] * 4), (302, [1.0, None, 0.0, 0.0]),
                                                                                   (303, [float("nan")] * 4), (304, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ev.top_matches(df.where("vec_id % 10 = 0"), df, 7, block_rows=64).collect():
        got.setdefault(r["query"], []).append((r["rank"], r["match"]))
    good = {k: np.array(v) for k, v in rows[:300] if any(v)}
    for q, v in good.items():
        if q % 10 == 0:
            near = sorted((-round(float(v @ w / np.sqrt((v @ v) * (w @ w))), 9), k) for k, w in good.items() if k != q)[:7]
            assert sorted(got[q]) == [(n + 1, k) for n, (_, k) in enumerate(near)]
    assert set(got) == {q for q in good if q % 10 == 0}


def test_runs_are_compared_by_their_best_step(spark):
    rows = [("a", 0, "loss", 3.0), ("a", 1, "loss", 1.0), ("a", 2, "loss", 1.0), ("b", 0, "loss", 0.5), ("b", 1, "loss", float("nan")),
            ("c", 0, "loss", 1.0), ("c", 1, "other", 0.0), ("d", 0, "loss", None)]
    m = spark.createDataFrame(rows, "run_id string, step int, key string, value double")
    low = {r.run_id: (r.n_steps, r.best_step, r.best, r.last, r.place) for r in ev.compare_runs(m, "loss").collect()}
    assert low == {"a": (3, 1, 1.0, 1.0, 2), "b": (1, 0, 0.5, 0.5, 1), "c": (1, 0, 1.0, 1.0, 2)}
    assert {r.run_id: r.place for r in ev.compare_runs(m, "loss", False).collect()} == {"a": 1, "b": 3, "c": 2}
