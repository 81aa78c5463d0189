"""Voxel operators against FIXTURES §5 goldens and NumPy formulations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom.operators import voxels as vx


def _assets(spark, rows):
    return spark.createDataFrame(rows, "uid string, category string, jitter int")


def test_shape_cell_goldens(spark):
    gold = {"cube": [2744] * 5, "sphere": [2512, 2800, 3016, 3328, 3544],
            "cylinder": [3888, 4320, 4608, 4824, 4968]}
    rows = [(f"{s}{j}", s, j) for s in gold for j in range(-2, 3)]
    got = {r.uid: r["count"] for r in vx.shape_cells(_assets(spark, rows)).groupBy("uid").count().collect()}
    for s, counts in gold.items():
        assert [got[f"{s}{j}"] for j in range(-2, 3)] == counts


def test_shape_cells_match_numpy_and_bounds(spark):
    c = 15.5
    x, y, z = np.indices((32, 32, 32), dtype=np.float32)
    ref = ((x - c) ** 2 + (y - c) ** 2 <= (32 * 0.28 + 0.25) ** 2) & (np.abs(z - c) <= 32 * 0.28)
    cells = vx.shape_cells(_assets(spark, [("c", "cylinder", 1)])).collect()
    got = np.zeros((32, 32, 32), bool)
    for r in cells:
        got[r.x, r.y, r.z] = True
    assert np.array_equal(got, ref)


def test_unsupported_shape_raises(spark):
    with pytest.raises(Exception, match="Unsupported synthetic shape"):
        vx.shape_cells(_assets(spark, [("p", "pyramid", 0)])).collect()


def test_cube_boundary_faces(spark):
    faces = vx.boundary_faces(vx.shape_cells(_assets(spark, [("c", "cube", 0)])))
    assert faces.count() == 1176


def test_nearest_lookup_21_to_32(spark):
    sizes = spark.createDataFrame([(21,)], "n int")
    lut = sorted((r.o, r.i) for r in vx.nearest_lookup(sizes, 32).collect())
    expect = "0 1 1 2 3 3 4 5 5 6 6 7 8 8 9 10 10 11 12 12 13 14 14 15 15 16 17 17 18 19 19 20"
    assert [i for _, i in lut] == [int(v) for v in expect.split()]


def test_nearest_range_inverts_lookup(spark):
    """The closed-form output range of each input index equals the brute-force
    inverse of ``i = floor(o*(n-1)/(T-1) + 1/2)`` (exact fractions)."""
    from fractions import Fraction
    cases = [(n, t, i) for t in (2, 3, 7, 32, 33, 64) for n in range(1, 90) for i in range(n)]
    df = spark.createDataFrame(cases, "n int, t int, i int")
    got = {}
    for t in {c[1] for c in cases}:
        lo, hi = vx.nearest_range(F.col("i"), F.col("n"), t)
        for r in df.where(F.col("t") == t).select("n", "i", lo.alias("lo"), hi.alias("hi")).collect():
            got[(r.n, t, r.i)] = set(range(r.lo, r.hi + 1))
    for n, t, i in cases:
        expect = {o for o in range(t)
                  if (0 if n <= 1 else int(Fraction(o * (n - 1), t - 1) + Fraction(1, 2))) == i}
        assert got[(n, t, i)] == expect, (n, t, i)


def test_resize_matches_numpy(spark):
    rng = np.random.default_rng(0)
    occ = rng.random((5, 21, 3)) < 0.3
    occ[0, 0, 0] = occ[4, 20, 2] = True
    rows = [("g", int(a), int(b), int(c)) for a, b, c in zip(*np.nonzero(occ))]
    df = spark.createDataFrame(rows, "uid string, x int, y int, z int")
    got = np.zeros((32, 32, 32), bool)
    for r in vx.resize_nearest(df, 32).collect():
        got[r.x, r.y, r.z] = True
    idx = [np.floor(np.arange(32) * (n - 1) / 31 + 0.5).astype(int) for n in occ.shape]
    ref = occ[np.ix_(*idx)]
    assert np.array_equal(got, ref)


def _tri_brute(tris, vs=0.05):
    pts = tris.reshape(-1, 3)
    lo, ext = pts.min(0), (pts.max(0) - pts.min(0)).max()
    rel = (tris - lo) / ext / vs + 0.5
    out = set()

    def sep(axis, v, h):
        p = v @ axis
        r = h * np.abs(axis).sum()
        return p.min() > r or p.max() < -r

    for t in rel:
        lo_i = np.floor(t.min(0)).astype(int)
        hi_i = np.floor(t.max(0)).astype(int)
        for i in range(lo_i[0], hi_i[0] + 1):
            for j in range(lo_i[1], hi_i[1] + 1):
                for k in range(lo_i[2], hi_i[2] + 1):
                    v = t - (np.array([i, j, k]) + 0.5)
                    e = [v[1] - v[0], v[2] - v[1], v[0] - v[2]]
                    axes = [np.eye(3)[a] for a in range(3)] + [np.cross(np.eye(3)[a], ed) for a in range(3) for ed in e]
                    axes.append(np.cross(e[0], e[1]))
                    if not any(sep(a, v, 0.5) for a in axes):
                        out.add((i, j, k))
    return out


def test_voxelize_triangles_matches_bruteforce(spark):
    rng = np.random.default_rng(1)
    tris = rng.random((12, 3, 3)) * np.array([1.0, 0.6, 0.3])
    rows = [("m", i, *map(float, t.reshape(-1))) for i, t in enumerate(tris)]
    df = spark.createDataFrame(rows, "uid string, fid int, ax double, ay double, az double, "
                                     "bx double, by double, bz double, cx double, cy double, cz double")
    got = {(r.x, r.y, r.z) for r in vx.voxelize_triangles(df).collect()}
    assert got == _tri_brute(tris)


def test_points_voxelize_and_mesh_checks(spark):
    pts = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("a", 1.0, 0.5, 0.25), ("b", 2.0, 2.0, 2.0)],
                                "uid string, x double, y double, z double")
    cells = sorted((r.x, r.y, r.z) for r in vx.voxelize_points(pts).where("uid = 'a'").collect())
    assert cells == [(0, 0, 0), (20, 10, 5)]
    chk = {r.uid: r.reason for r in vx.mesh_checks(vx.mesh_bounds(pts)).collect()}
    assert chk["a"] is None and chk["b"] == "ValueError: Degenerate mesh: b"


def test_dense_round_trip_and_levels(spark):
    cells = vx.shape_cells(_assets(spark, [("s", "sphere", 0)]))
    dense = vx.to_dense(cells, 32).first()
    assert len(dense.grid) == 32 ** 3 and max(dense.grid) == 1.0 and min(dense.grid) == 0.0
    back = vx.from_dense(vx.to_dense(cells, 32), 32)
    assert back.count() == 3016
    st = {r.uid: r for r in vx.adaptive_level(vx.grid_stats(cells, 32), 0.5).collect()}
    assert st["s"].level == 0.5 and st["s"].reason is None
    low = cells.withColumn("value", F.lit(0.3).cast("float"))
    st = vx.adaptive_level(vx.grid_stats(low, 32), 0.5).first()
    assert abs(st.level - 0.15) < 1e-6
    bad = spark.createDataFrame([("n", 0, 0, 0, float("nan"))], "uid string, x int, y int, z int, value float")
    assert vx.adaptive_level(vx.grid_stats(bad, 32)).first().reason == "Voxel grid contains non-finite values"


def test_crossing_vertices_single_cell(spark):
    c = spark.createDataFrame([("u", 5, 5, 5, 1.0)], "uid string, x int, y int, z int, value float")
    v = vx.crossing_vertices(c, 0.5, 32).collect()
    assert len(v) == 6
    assert sorted((r.px, r.py, r.pz) for r in v)[0] == (4.5, 5.0, 5.0)


def test_surface_of_tall_and_negative_columns_equals_brute_force(spark):
    import random
    rng = random.Random(4)
    cells = {(rng.randint(-2, 2), rng.randint(0, 2), z) for z in [*range(-70, -50), *range(55, 70), 120, 123, 124, 125, 200]
             for _ in range(3)}
    df = spark.createDataFrame([("u", *c) for c in cells], "uid string, x int, y int, z int")
    want = {(*c, f) for c in cells for f, d in {"+x": (1, 0, 0), "-x": (-1, 0, 0), "+y": (0, 1, 0), "-y": (0, -1, 0),
                                                "+z": (0, 0, 1), "-z": (0, 0, -1)}.items()
            if tuple(a + b for a, b in zip(c, d)) not in cells}
    got = vx.boundary_faces(df).collect()
    assert len(got) == len(want) and {(r.x, r.y, r.z, r.face) for r in got} == want
