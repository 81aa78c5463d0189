"""Voxel and mesh queries.

Assets: ``documents.doc_id`` numbers the synthetic assets (so the work grows
with the table), and every ``embeddings`` label is one point cloud whose
points are its vectors, cut into threes (the last wraps to the front). ``embeddings`` rows
also double as 4x4x4 grids of predicted values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..operators import voxels as vx
from .registry import query, table

ROUND = 6


def _assets(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return cat.synthetic_manifest(ids)


_ASSETS_SQL = """
  a0 AS (SELECT doc_id, ['cube', 'sphere', 'cylinder'][doc_id % 3 + 1] AS shape FROM documents),
  a AS (SELECT doc_id AS i, printf('synthetic-%s-%04d', shape, doc_id) AS uid, shape AS category,
               CAST(doc_id % 5 - 2 AS INTEGER) AS jitter FROM a0)"""

_CELLS_SQL = _ASSETS_SQL + """,
  g AS (SELECT a.uid, a.category, CAST(a.jitter AS DOUBLE) AS j, tx.x, ty.y, tz.z
        FROM a, range(32) tx(x), range(32) ty(y), range(32) tz(z)),
  c AS (SELECT uid, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CAST(z AS INTEGER) AS z FROM g
        WHERE CASE category
          WHEN 'sphere' THEN (x - 15.5) * (x - 15.5) + (y - 15.5) * (y - 15.5) + (z - 15.5) * (z - 15.5)
                             <= (8.96 + j * 0.25) * (8.96 + j * 0.25)
          WHEN 'cylinder' THEN (x - 15.5) * (x - 15.5) + (y - 15.5) * (y - 15.5)
                             <= (8.96 + j * 0.25) * (8.96 + j * 0.25) AND abs(z - 15.5) <= 8.96
          ELSE abs(x - 15.5) <= greatest(3, trunc(7.68 + j * 0.1))
               AND abs(y - 15.5) <= greatest(3, trunc(7.68 + j * 0.1))
               AND abs(z - 15.5) <= greatest(3, trunc(7.68 + j * 0.1)) END)"""


@query("synthetic_manifest", "S10 P04 P05 P03 J08 U05", oracle=f"""
  WITH {_ASSETS_SQL}
  SELECT i, uid, category, 'a simple ' || category || ' shaped 3d object' AS description,
         'data/processed/voxels/' || uid || '.pt' AS voxel_path,
         'data/processed/embeddings/' || uid || '.pt' AS embedding_path,
         'synthetic' AS source, jitter
  FROM a
""")
def q_synthetic_manifest(spark, sf_dir):
    return _assets(spark, sf_dir)


@query("synthetic_shape_cells", "V01 F15 M02 M03", oracle=f"""
  WITH {_CELLS_SQL}
  SELECT uid, COUNT(*) AS n_cells, CAST(SUM(x) AS BIGINT) AS sum_x, CAST(SUM(y) AS BIGINT) AS sum_y,
         CAST(SUM(z) AS BIGINT) AS sum_z, CAST(SUM(x * y * z) AS BIGINT) AS sum_xyz
  FROM c GROUP BY uid
""")
def q_synthetic_shape_cells(spark, sf_dir):
    cells = vx.shape_cells(_assets(spark, sf_dir))
    x, y, z = (F.col(a).cast("long") for a in "xyz")
    return cells.groupBy("uid").agg(F.count(F.lit(1)).alias("n_cells"), F.sum(x).alias("sum_x"),
                                    F.sum(y).alias("sum_y"), F.sum(z).alias("sum_z"),
                                    F.sum(x * y * z).alias("sum_xyz"))


@query("surface_faces", "V15b J10", oracle=f"""
  WITH {_CELLS_SQL},
  d AS (SELECT * FROM (VALUES (1, 0, 0, '+x'), (-1, 0, 0, '-x'), (0, 1, 0, '+y'), (0, -1, 0, '-y'),
                              (0, 0, 1, '+z'), (0, 0, -1, '-z')) t(dx, dy, dz, face)),
  cd AS (SELECT c.uid, c.x, c.y, c.z, d.face, c.x + d.dx AS nx, c.y + d.dy AS ny, c.z + d.dz AS nz
         FROM c, d),
  f AS (SELECT cd.* FROM cd ANTI JOIN c ON c.uid = cd.uid AND c.x = cd.nx AND c.y = cd.ny AND c.z = cd.nz)
  SELECT uid, face, COUNT(*) AS n_faces, CAST(SUM(x + 32 * y + 1024 * z) AS BIGINT) AS pos_sum
  FROM f GROUP BY uid, face
""")
def q_surface_faces(spark, sf_dir):
    fm = vx.boundary_face_masks(vx.shape_cells(vx.by_key(_assets(spark, sf_dir))))
    cnt, zsum = vx.mask_count_and_zsum(F.col("fm"))
    pos = cnt * (F.col("x").cast("long") + 32 * F.col("y")) + 1024 * (zsum + cnt * F.col("z0"))
    return fm.groupBy("uid", "face").agg(F.sum(cnt).alias("n_faces"), F.sum(pos).alias("pos_sum"))


def _points(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").where(F.size("embedding") > 0)
    n = F.size("embedding")
    cut = e.select("label", "vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.ceil(n / 3).cast("int") - 1)).alias("k"))
    return cut.select(F.col("label").cast("string").alias("uid"),
                      (F.col("vec_id") * F.ceil(n / 3) + F.col("k")).cast("long").alias("vid"),
                      *[F.element_at("embedding", (F.col("k") * 3 + i) % n + 1).cast("double").alias(a)
                        for i, a in enumerate("xyz")])


_POINTS_SQL = """
  pk AS (SELECT label, vec_id, embedding, len(embedding) AS n, (len(embedding) + 2) // 3 AS m,
                unnest(range((len(embedding) + 2) // 3)) AS k FROM embeddings),
  p AS (SELECT CAST(label AS VARCHAR) AS uid, CAST(vec_id * m + k AS BIGINT) AS vid,
               CAST(embedding[(3 * k) % n + 1] AS DOUBLE) AS x, CAST(embedding[(3 * k + 1) % n + 1] AS DOUBLE) AS y,
               CAST(embedding[(3 * k + 2) % n + 1] AS DOUBLE) AS z FROM pk),
  b AS (SELECT uid, COUNT(*) AS n_points, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y,
               max(y) AS max_y, min(z) AS min_z, max(z) AS max_z,
               greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS max_extent
        FROM p GROUP BY uid)"""

_VOXELS_SQL = _POINTS_SQL + """,
  v AS (SELECT DISTINCT p.uid,
               CAST(floor((p.x - b.min_x) / b.max_extent / 0.05 + 0.5) AS INTEGER) AS x,
               CAST(floor((p.y - b.min_y) / b.max_extent / 0.05 + 0.5) AS INTEGER) AS y,
               CAST(floor((p.z - b.min_z) / b.max_extent / 0.05 + 0.5) AS INTEGER) AS z
        FROM p JOIN b ON p.uid = b.uid WHERE b.max_extent > 0),
  vs AS (SELECT uid, min(x) AS lx, min(y) AS ly, min(z) AS lz,
                max(x) - min(x) + 1 AS n_x, max(y) - min(y) + 1 AS n_y, max(z) - min(z) + 1 AS n_z
         FROM v GROUP BY uid),
  sc AS (SELECT v.uid, v.x - vs.lx AS x, v.y - vs.ly AS y, v.z - vs.lz AS z, vs.n_x, vs.n_y, vs.n_z
         FROM v JOIN vs ON v.uid = vs.uid)"""


@query("mesh_bounds", "V02 A10 F13", oracle=f"""
  WITH {_POINTS_SQL}
  SELECT uid, n_points, round(min_x, 6) AS min_x, round(max_x, 6) AS max_x, round(min_y, 6) AS min_y,
         round(max_y, 6) AS max_y, round(min_z, 6) AS min_z, round(max_z, 6) AS max_z,
         round(max_extent, 6) AS max_extent,
         CASE WHEN n_points = 0 THEN 'ValueError: Empty mesh: ' || uid
              WHEN max_extent <= 0 THEN 'ValueError: Degenerate mesh: ' || uid END AS reason
  FROM b
""")
def q_mesh_bounds(spark, sf_dir):
    b = vx.mesh_checks(vx.mesh_bounds(_points(spark, sf_dir)))
    cols = [f"{m}_{a}" for a in "xyz" for m in ("min", "max")] + ["max_extent"]
    return b.select("uid", "n_points", *[F.round(c, ROUND).alias(c) for c in cols], "reason")


@query("point_voxels", "V03 V04a V05 V06 V07", oracle=f"""
  WITH {_VOXELS_SQL}
  SELECT uid, x, y, z, n_x, n_y, n_z FROM sc
""")
def q_point_voxels(spark, sf_dir):
    return vx.shift_to_origin(vx.voxelize_points(_points(spark, sf_dir)))


@query("resize_nearest", "V09 V10 V11 J09", oracle=f"""
  WITH {_VOXELS_SQL},
  o AS (SELECT CAST(range AS INTEGER) AS o FROM range(32)),
  r AS (SELECT DISTINCT sc.uid, ox.o AS x, oy.o AS y, oz.o AS z FROM sc
        JOIN o ox ON sc.x = CASE WHEN sc.n_x <= 1 THEN 0 ELSE floor(ox.o * (sc.n_x - 1) / 31 + 0.5) END
        JOIN o oy ON sc.y = CASE WHEN sc.n_y <= 1 THEN 0 ELSE floor(oy.o * (sc.n_y - 1) / 31 + 0.5) END
        JOIN o oz ON sc.z = CASE WHEN sc.n_z <= 1 THEN 0 ELSE floor(oz.o * (sc.n_z - 1) / 31 + 0.5) END)
  SELECT uid, x, y, z FROM r
""")
def q_resize_nearest(spark, sf_dir):
    r = vx.resize_nearest(vx.voxelize_points(_points(spark, sf_dir)))
    return r.select("uid", *[F.col(a).cast("int").alias(a) for a in "xyz"])


@query("crossing_vertices", "V15a", oracle=f"""
  WITH {_VOXELS_SQL},
  o AS (SELECT CAST(range AS INTEGER) AS o FROM range(32)),
  r AS (SELECT DISTINCT sc.uid, ox.o AS x, oy.o AS y, oz.o AS z FROM sc
        JOIN o ox ON sc.x = CASE WHEN sc.n_x <= 1 THEN 0 ELSE floor(ox.o * (sc.n_x - 1) / 31 + 0.5) END
        JOIN o oy ON sc.y = CASE WHEN sc.n_y <= 1 THEN 0 ELSE floor(oy.o * (sc.n_y - 1) / 31 + 0.5) END
        JOIN o oz ON sc.z = CASE WHEN sc.n_z <= 1 THEN 0 ELSE floor(oz.o * (sc.n_z - 1) / 31 + 0.5) END),
  ax AS (SELECT * FROM (VALUES ('x', 1, 0, 0), ('y', 0, 1, 0), ('z', 0, 0, 1)) t(axis, ex, ey, ez)),
  e AS (SELECT r.uid, ax.axis, r.x, r.y, r.z, ax.ex, ax.ey, ax.ez FROM r, ax
        UNION
        SELECT r.uid, ax.axis, r.x - ax.ex, r.y - ax.ey, r.z - ax.ez, ax.ex, ax.ey, ax.ez FROM r, ax),
  ev AS (SELECT e.*,
           CASE WHEN EXISTS (SELECT 1 FROM r r1 WHERE r1.uid = e.uid AND r1.x = e.x AND r1.y = e.y
                             AND r1.z = e.z) THEN 1.0 ELSE 0.0 END AS a,
           CASE WHEN EXISTS (SELECT 1 FROM r r2 WHERE r2.uid = e.uid AND r2.x = e.x + e.ex
                             AND r2.y = e.y + e.ey AND r2.z = e.z + e.ez) THEN 1.0 ELSE 0.0 END AS b
         FROM e WHERE e.x >= 0 AND e.y >= 0 AND e.z >= 0
           AND e.x + e.ex < 32 AND e.y + e.ey < 32 AND e.z + e.ez < 32)
  SELECT uid, axis, x, y, z,
         round(x + ex * (0.5 - a) / (b - a), 6) AS px, round(y + ey * (0.5 - a) / (b - a), 6) AS py,
         round(z + ez * (0.5 - a) / (b - a), 6) AS pz
  FROM ev WHERE (a >= 0.5) <> (b >= 0.5)
""")
def q_crossing_vertices(spark, sf_dir):
    r = vx.resize_nearest(vx.voxelize_points(_points(spark, sf_dir)))
    v = vx.crossing_vertices(r, 0.5, 32)
    return v.select("uid", "axis", *[F.col(a).cast("int").alias(a) for a in "xyz"],
                    *[F.round(f"p{a}", ROUND).alias(f"p{a}") for a in "xyz"])


def _grids(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("uid"),
                                                     F.col("embedding").alias("grid"))


def _grid_cells(spark, sf_dir):
    return vx.from_dense(_grids(spark, sf_dir), size=4, keep_zeros=True)


_GRID_SQL = """
  gc AS (SELECT CAST(vec_id AS VARCHAR) AS uid, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i,
                CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings),
  gcells AS (SELECT uid, i // 16 AS x, (i // 4) % 4 AS y, i % 4 AS z, value FROM gc)"""


@query("grid_checks", "V14 F14 A11", oracle=f"""
  WITH {_GRID_SQL},
  s AS (SELECT uid, COUNT(*) AS n_cells,
               COUNT(*) FILTER (WHERE isnan(value) OR isinf(value)) AS n_nonfinite,
               CASE WHEN COUNT(*) >= 64 THEN min(value) ELSE least(min(value), 0) END AS grid_min,
               CASE WHEN COUNT(*) >= 64 THEN max(value) ELSE greatest(max(value), 0) END AS grid_max
        FROM gcells GROUP BY uid)
  SELECT uid, n_cells, n_nonfinite, round(grid_min, 6) AS grid_min, round(grid_max, 6) AS grid_max,
         CASE WHEN n_nonfinite > 0 OR grid_max <= grid_min THEN NULL
              WHEN grid_max <= 0.5 OR grid_min >= 0.5 THEN round((grid_min + grid_max) / 2, 6)
              ELSE 0.5 END AS level,
         CASE WHEN n_nonfinite > 0 THEN 'Voxel grid contains non-finite values'
              WHEN grid_max <= grid_min THEN 'Voxel grid has no isosurface' END AS reason
  FROM s
""")
def q_grid_checks(spark, sf_dir):
    s = vx.adaptive_level(vx.grid_stats(_grid_cells(spark, sf_dir), size=4), 0.5)
    return s.select("uid", "n_cells", "n_nonfinite", F.round("grid_min", ROUND).alias("grid_min"),
                    F.round("grid_max", ROUND).alias("grid_max"), F.round("level", ROUND).alias("level"),
                    "reason")


@query("axis_slice", "V18 V13", oracle=f"""
  WITH {_GRID_SQL}
  SELECT uid, CAST(y AS INTEGER) AS y, CAST(z AS INTEGER) AS z, round(value, 6) AS value
  FROM gcells WHERE x = 2
""")
def q_axis_slice(spark, sf_dir):
    s = vx.axis_slice(_grid_cells(spark, sf_dir), "x", 2)
    return s.select("uid", F.col("y").cast("int"), F.col("z").cast("int"),
                    F.round(F.col("value").cast("double"), ROUND).alias("value"))


@query("occupancy", "V19 V13", oracle=f"""
  WITH {_GRID_SQL}
  SELECT uid, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CAST(z AS INTEGER) AS z
  FROM gcells WHERE value > 0.1
""")
def q_occupancy(spark, sf_dir):
    o = vx.occupancy(_grid_cells(spark, sf_dir), 0.1)
    return o.select("uid", *[F.col(a).cast("int").alias(a) for a in "xyz"])


@query("normalise_mesh", "V16", oracle=f"""
  WITH {_POINTS_SQL}
  SELECT p.uid, p.vid,
         round((p.x - (b.min_x + b.max_x) / 2) / CASE WHEN b.max_extent > 0 THEN b.max_extent ELSE 1 END, 6) AS x,
         round((p.y - (b.min_y + b.max_y) / 2) / CASE WHEN b.max_extent > 0 THEN b.max_extent ELSE 1 END, 6) AS y,
         round((p.z - (b.min_z + b.max_z) / 2) / CASE WHEN b.max_extent > 0 THEN b.max_extent ELSE 1 END, 6) AS z
  FROM p JOIN b ON p.uid = b.uid
""")
def q_normalise_mesh(spark, sf_dir):
    n = vx.normalise_vertices(_points(spark, sf_dir))
    return n.select("uid", "vid", *[F.round(a, ROUND).alias(a) for a in "xyz"])


@query("centre_on_mean", "V17", oracle=f"""
  WITH {_POINTS_SQL},
  m AS (SELECT uid, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM p GROUP BY uid),
  c AS (SELECT p.uid, p.vid, p.x - m.mx AS x, p.y - m.my AS y, p.z - m.mz AS z FROM p JOIN m ON p.uid = m.uid),
  e AS (SELECT uid, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS ext FROM c GROUP BY uid)
  SELECT c.uid, c.vid, round(c.x / CASE WHEN e.ext > 0 THEN e.ext ELSE 1 END, 6) AS x,
         round(c.y / CASE WHEN e.ext > 0 THEN e.ext ELSE 1 END, 6) AS y,
         round(c.z / CASE WHEN e.ext > 0 THEN e.ext ELSE 1 END, 6) AS z
  FROM c JOIN e ON c.uid = e.uid
""")
def q_centre_on_mean(spark, sf_dir):
    n = vx.centre_on_mean(_points(spark, sf_dir))
    return n.select("uid", "vid", *[F.round(a, ROUND).alias(a) for a in "xyz"])
