"""Prompt to mesh, iso-surfaces and measures of shapes and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import scoring as sc
from ..operators import surface as sf
from ..operators import training as tr
from ..operators import voxels as vx
from .q_training import _prompts
from .q_voxels import _GRID_SQL, ROUND, _grid_cells, _grids, _points
from .registry import query, table

_LEVEL = """CASE WHEN grid_max <= thr OR grid_min >= thr THEN (grid_min + grid_max) / 2 ELSE thr END"""

#: From cells sc(uid, x, y, z, value, t): crossed edges, and the vertices and quads around them.
_SURFACE_SQL = """
  d(dx, dy, dz, axis) AS (VALUES (1, 0, 0, 'x'), (-1, 0, 0, 'x'), (0, 1, 0, 'y'), (0, -1, 0, 'y'), (0, 0, 1, 'z'), (0, 0, -1, 'z')),
  cand AS (SELECT sc.uid, sc.x, sc.y, sc.z, sc.value AS a, sc.t, d.* FROM sc, d WHERE sc.value >= sc.t),
  cross_e AS (SELECT k.*, n.value AS b FROM cand k LEFT JOIN sc n
                ON n.uid = k.uid AND n.x = k.x + k.dx AND n.y = k.y + k.dy AND n.z = k.z + k.dz
              WHERE n.value IS NULL OR n.value < n.t),
  pts AS (SELECT *, CASE WHEN b IS NULL AND t <= 0 THEN 0.5 ELSE (t - a) / (coalesce(b, 0.0) - a) END AS f FROM cross_e),
  edges AS (SELECT uid, axis, dx + dy + dz AS side, least(x, x + dx) AS ex, least(y, y + dy) AS ey, least(z, z + dz) AS ez,
                   x + dx * f AS px, y + dy * f AS py, z + dz * f AS pz FROM pts),
  o(axis, n, oi, oj, ok) AS (VALUES ('x', 0, 0, -1, -1), ('x', 1, 0, 0, -1), ('x', 2, 0, 0, 0), ('x', 3, 0, -1, 0),
                                    ('y', 0, -1, 0, -1), ('y', 1, -1, 0, 0), ('y', 2, 0, 0, 0), ('y', 3, 0, 0, -1),
                                    ('z', 0, -1, -1, 0), ('z', 1, 0, -1, 0), ('z', 2, 0, 0, 0), ('z', 3, -1, 0, 0)),
  corners AS (SELECT e.*, o.n, ex + oi AS i, ey + oj AS j, ez + ok AS k FROM edges e JOIN o ON o.axis = e.axis),
  verts AS (SELECT uid, i, j, k, avg(px) AS x, avg(py) AS y, avg(pz) AS z FROM corners GROUP BY uid, i, j, k)"""

_GRID_LEVEL_SQL = _GRID_SQL + f""",
  st AS (SELECT uid, min(value) AS grid_min, max(value) AS grid_max, 0.5 AS thr FROM gcells GROUP BY uid),
  lv AS (SELECT uid, {_LEVEL} AS t FROM st WHERE grid_max > grid_min),
  sc AS (SELECT g.uid, g.x, g.y, g.z, g.value, lv.t FROM gcells g JOIN lv ON lv.uid = g.uid),""" + _SURFACE_SQL


def _levelled(spark, sf_dir):
    """Cells and levels of the grids, which are laid out by key; the join is a merge at any size, as both sides are in place."""
    cells = vx.from_dense(vx.by_key(_grids(spark, sf_dir)), size=4, keep_zeros=True)
    levels = vx.adaptive_level(vx.grid_stats(cells, size=4), 0.5).where("reason IS NULL").select("uid", "level")
    return cells.join(levels.hint("merge"), "uid")


@query("dual_vertices", "V15 V14 F14", oracle=f"""
  WITH {_GRID_LEVEL_SQL}
  SELECT uid, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CAST(k AS INTEGER) AS k,
         round(x, 5) AS x, round(y, 5) AS y, round(z, 5) AS z FROM verts
""")
def q_dual_vertices(spark, sf_dir):
    v, _ = sf.dual_surface(_levelled(spark, sf_dir), F.col("level"))
    return v.select("uid", "i", "j", "k", *[F.round(a, 5).alias(a) for a in "xyz"])


@query("dual_triangles", "V15 V14", oracle=f"""
  WITH {_GRID_LEVEL_SQL},
  placed AS (SELECT c.uid, c.axis, c.ex, c.ey, c.ez, CASE WHEN c.side > 0 THEN c.n ELSE (4 - c.n) % 4 END AS n, v.x, v.y, v.z
             FROM corners c JOIN verts v ON v.uid = c.uid AND v.i = c.i AND v.j = c.j AND v.k = c.k),
  quad AS (SELECT uid, axis, ex, ey, ez, {", ".join(f"max({a}) FILTER (WHERE n = {n}) AS {a}{n}" for n in range(4) for a in "xyz")}
           FROM placed GROUP BY uid, axis, ex, ey, ez),
  tri AS (SELECT uid, x0 AS ax, y0 AS ay, z0 AS az, x1 AS bx, y1 AS by_, z1 AS bz, x2 AS cx, y2 AS cy, z2 AS cz FROM quad
          UNION ALL SELECT uid, x0, y0, z0, x2, y2, z2, x3, y3, z3 FROM quad)
  SELECT uid, COUNT(*) AS n_triangles,
         round(SUM(ax * (by_ * cz - bz * cy) + ay * (bz * cx - bx * cz) + az * (bx * cy - by_ * cx)) / 6, 4) + 0.0 AS volume
  FROM tri GROUP BY uid
""")
def q_dual_triangles(spark, sf_dir):
    """The enclosed volume, from the triangles' corners: it has the right sign only if all are turned outwards.

    A triangle that stands ``n`` times (in grids of repeated rows) counts as often.
    """
    v, t = sf.dual_surface(_levelled(spark, sf_dir), F.col("level"))
    corners = t.select("uid", F.struct(*[c for c in t.columns if c != "uid"]).alias("t"), F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), *[F.col(f"{p}{n}").alias(n) for n in sf.CUBE]) for p in "abc"])).alias("c"))
    placed = sf.at_cells(corners.select("uid", "t", "c.*"), v, "uid", list(sf.CUBE))
    t = placed.groupBy("uid", "t").agg(F.count_if(F.col("p") == "a").alias("n"), *[
        F.max(F.when(F.col("p") == p, F.col(a))).alias(f"{p}{a}") for p in "abc" for a in "xyz"])
    a, b, c = ([F.col(f"{p}{x}") for x in "xyz"] for p in "abc")
    six = sum((a[k] * (b[(k + 1) % 3] * c[(k + 2) % 3] - b[(k + 2) % 3] * c[(k + 1) % 3]) for k in range(3)), F.lit(0.0))
    return t.groupBy("uid").agg(F.sum("n").alias("n_triangles"), (F.round(F.sum(six * F.col("n")) / 6, 4) + 0.0).alias("volume"))


_SIDE, _TEXT_DIM = 4, 16


def _stand_in_model():
    """A fixed generator: each cell is a logistic function of the embedding, with weights by rule."""
    import numpy as np
    cell, dim = np.arange(_SIDE ** 3)[:, None], np.arange(_TEXT_DIM)[None, :]
    weights = ((cell * 7 + dim * 13) % 11 - 5) / 2.0
    bias = (cell[:, 0] % 5 - 2) * 0.3 + 0.037

    def predict(x):
        return (1.0 / (1.0 + np.exp(-(x.astype(np.float64) @ weights.T + bias)))).astype(np.float32)
    return predict


def _requests(spark, sf_dir):
    """Prompts of the user turns; some rows stand twice, some without an id, some share one."""
    p = _prompts(spark, sf_dir).withColumn("c", F.col("seed") % 10)
    p = p.withColumn("prompt_id", F.when(F.col("c") == 1, F.lit(None)).when(F.col("c") == 2, F.col("seed").cast("string"))
                     .otherwise(F.col("prompt_id")))
    return p.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("c") < 3, 2).otherwise(1)))).drop("c", "copy")


@query("prompt_mesh", "X07 X08 V14 V15 F08 F11 F12 F14 P08 T08 T09", oracle=rf"""
  WITH p0 AS (SELECT conv_id, turn, CASE conv_id % 10 WHEN 1 THEN NULL WHEN 2 THEN CAST(conv_id AS VARCHAR)
                       ELSE CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) END AS prompt_id,
                     CASE WHEN turn % 5 = 1 THEN '   ' ELSE text END AS prompt, CAST(conv_id AS INTEGER) AS seed,
                     coalesce(CASE WHEN conv_id % 7 = 0 THEN 0.0 WHEN conv_id % 7 = 1 THEN 1.0
                                   WHEN conv_id % 7 = 2 THEN NULL ELSE 0.25 END, 0.5)::DOUBLE AS thr
              FROM conversations WHERE role = 'user'),
  pr AS (SELECT p0.* FROM p0, (VALUES (1), (2)) two(copy) WHERE copy = 1 OR conv_id % 10 < 3),
  pv AS (SELECT *, sha256(concat_ws(chr(31), coalesce('=' || prompt_id, '?'), coalesce('=' || prompt, '?'),
                          coalesce('=' || CAST(seed AS VARCHAR), '?'), coalesce('=' || CAST(thr AS VARCHAR), '?'))) AS uid,
           CASE WHEN prompt IS NULL OR length(prompt) < 1 THEN 'prompt: String should have at least 1 character'
                WHEN length(prompt) > 300 THEN 'prompt: String should have at most 300 characters'
                WHEN thr <= 0 THEN 'threshold: Input should be greater than 0'
                WHEN thr >= 1 THEN 'threshold: Input should be less than 1'
                WHEN regexp_full_match(prompt, '\s*') THEN 'Prompt must not be empty' END AS invalid,
           coalesce(nullif(left(regexp_replace(regexp_replace(lower(prompt), '[^a-z0-9]+', '-', 'g'),
                                               '^-+|-+$', '', 'g'), 40), ''), 'shape') AS stem
         FROM pr),
  rq AS (SELECT DISTINCT uid, prompt, thr FROM pv WHERE invalid IS NULL),
  t0 AS (SELECT uid, regexp_extract_all(lower(prompt), '[a-z0-9-]+') AS toks FROM rq),
  t1 AS (SELECT uid, unnest(CASE WHEN len(toks) = 0 THEN ['empty'] ELSE toks END) AS token FROM t0),
  t2 AS (SELECT uid, CAST(('0x' || substr(md5(token), 1, 8))::BIGINT % {_TEXT_DIM} AS INTEGER) AS slot,
                SUM(CASE WHEN ('0x' || substr(md5(token), 9, 2))::INTEGER % 2 = 0 THEN 1.0 ELSE -1.0 END) AS w FROM t1 GROUP BY ALL),
  nm AS (SELECT uid, sqrt(SUM(w * w)) AS norm FROM t2 GROUP BY uid),
  em AS (SELECT t2.uid, slot, CAST(CAST(CASE WHEN norm > 0 THEN w / norm ELSE 0 END AS FLOAT) AS DOUBLE) AS v
         FROM t2 JOIN nm ON nm.uid = t2.uid),
  cl AS (SELECT range AS c FROM range({_SIDE ** 3})),
  dots AS (SELECT em.uid, cl.c, SUM(em.v * ((cl.c * 7 + em.slot * 13) % 11 - 5) / 2.0) AS dot FROM em, cl GROUP BY ALL),
  gc AS (SELECT uid, c // 16 AS x, (c // 4) % 4 AS y, c % 4 AS z,
                CAST(CAST(1.0 / (1.0 + exp(-(dot + (c % 5 - 2) * 0.3 + 0.037))) AS FLOAT) AS DOUBLE) AS value FROM dots),
  st AS (SELECT g.uid, min(value) AS grid_min, max(value) AS grid_max, any_value(rq.thr) AS thr
         FROM gc g JOIN rq ON rq.uid = g.uid GROUP BY g.uid),
  lv AS (SELECT uid, {_LEVEL} AS t FROM st WHERE grid_max > grid_min),
  sc AS (SELECT g.*, lv.t FROM gc g JOIN lv ON lv.uid = g.uid), {_SURFACE_SQL},
  nv AS (SELECT uid, COUNT(*) AS n_vertices FROM verts GROUP BY uid),
  nt AS (SELECT uid, 2 * COUNT(*) AS n_triangles FROM edges GROUP BY uid),
  res AS (SELECT pv.*, lv.t, nv.n_vertices, nt.n_triangles, CASE WHEN invalid IS NULL AND lv.t IS NULL
                   THEN 'Voxel grid has no isosurface' ELSE invalid END AS reason
          FROM pv LEFT JOIN lv ON lv.uid = pv.uid LEFT JOIN nv ON nv.uid = pv.uid LEFT JOIN nt ON nt.uid = pv.uid)
  SELECT prompt_id, prompt, thr AS threshold, reason, round(t, 5) AS level, coalesce(n_vertices, 0) AS n_vertices,
         coalesce(n_triangles, 0) AS n_triangles,
         CASE WHEN reason IS NULL THEN '/meshes/' || stem || '-' || substr(md5(uid), 1, 8) || '.obj' END AS download_url
  FROM res
""")
def q_prompt_mesh(spark, sf_dir):
    registry = tr.registry_row(spark, "stand-in", _TEXT_DIM, 0, "hash", "signed-hash-md5", 42, "", (_SIDE,) * 3)
    made = sc.prompt_meshes(_requests(spark, sf_dir), registry, "stand-in", {"stand-in": _stand_in_model})
    return made.requests.select("prompt_id", "prompt", "threshold", "reason", F.round("level", 5).alias("level"),
                                "n_vertices", "n_triangles", "download_url")


_PAIR_SQL = _GRID_SQL + """,
  occ AS (SELECT uid, x, y, z FROM gcells WHERE value > 0.1),
  an AS (SELECT CAST(vec_id AS VARCHAR) AS uid, CAST(vec_id - vec_id % 10 AS VARCHAR) AS first FROM embeddings)"""


@query("voxel_iou", "R02 V19", oracle=f"""
  WITH {_PAIR_SQL},
  tg AS (SELECT an.uid, o.x, o.y, o.z FROM an JOIN occ o ON o.uid = an.first),
  j AS (SELECT coalesce(a.uid, b.uid) AS uid, a.uid IS NOT NULL AND b.uid IS NOT NULL AS both_
        FROM occ a FULL JOIN tg b ON a.uid = b.uid AND a.x = b.x AND a.y = b.y AND a.z = b.z),
  s AS (SELECT uid, COUNT(*) FILTER (WHERE both_) AS n_both, COUNT(*) AS n_either FROM j GROUP BY uid)
  SELECT an.uid, coalesce(n_both, 0) AS n_both, coalesce(n_either, 0) AS n_either,
         CASE WHEN n_either > 0 THEN round(n_both / n_either, 6) END AS iou
  FROM an LEFT JOIN s ON s.uid = an.uid
""")
def q_voxel_iou(spark, sf_dir):
    """Each vector's grid against that of the first of its ten."""
    cells = vx.occupancy(_grid_cells(spark, sf_dir), 0.1)
    ids = table(spark, sf_dir, "embeddings").select("vec_id")
    first = ids.select(F.col("vec_id").cast("string").alias("_u"), (F.col("vec_id") - F.col("vec_id") % 10).cast("string").alias("uid"))
    target = cells.join(first, "uid").select(F.col("_u").alias("uid"), "x", "y", "z")
    out = ev.voxel_iou(cells, target, uids=ids.select(F.col("vec_id").cast("string").alias("uid")))
    return out.select("uid", "n_both", "n_either", F.round("iou", ROUND).alias("iou"))


@query("seed_diversity", "R05 V19", oracle=f"""
  WITH {_GRID_SQL},
  g AS (SELECT e.label, CAST(e.vec_id AS VARCHAR) AS uid FROM embeddings e),
  occ AS (SELECT g.label, c.uid, c.x, c.y, c.z FROM gcells c JOIN g ON g.uid = c.uid WHERE c.value > 0.1),
  pc AS (SELECT label, x, y, z, COUNT(*) AS m FROM occ GROUP BY label, x, y, z),
  s AS (SELECT label, SUM(m)::BIGINT AS cells, SUM(m * (m - 1) // 2)::BIGINT AS b FROM pc GROUP BY label),
  n AS (SELECT label, COUNT(*) AS n_seeds FROM g GROUP BY label)
  SELECT n.label, n_seeds, coalesce(b, 0) AS "both", (n_seeds - 1) * coalesce(cells, 0) - coalesce(b, 0) AS either,
         CASE WHEN (n_seeds - 1) * cells - b > 0 THEN round(1 - b / ((n_seeds - 1) * cells - b), 6) END AS diversity
  FROM n LEFT JOIN s ON s.label = n.label
""")
def q_seed_diversity(spark, sf_dir):
    """Labels as prompts, their vectors' grids as what the seeds gave."""
    grids = table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").cast("string").alias("uid"))
    cells = vx.occupancy(_grid_cells(spark, sf_dir), 0.1).join(grids, "uid")
    out = ev.seed_diversity(cells, "label", "uid", grids)
    return out.select("label", "n_seeds", "both", "either", F.round("diversity", ROUND).alias("diversity"))


@query("chamfer", "R03", oracle="""
  WITH pk AS (SELECT label, vec_id, embedding, len(embedding) AS n, unnest(range((len(embedding) + 2) // 3)) AS k FROM embeddings),
  p AS (SELECT CAST(label AS VARCHAR) AS uid, CAST(embedding[(3 * k) % n + 1] AS DOUBLE) AS x,
               CAST(embedding[(3 * k + 1) % n + 1] AS DOUBLE) AS y, CAST(embedding[(3 * k + 2) % n + 1] AS DOUBLE) AS z FROM pk),
  pr AS (SELECT DISTINCT CAST(a.label AS VARCHAR) AS a, CAST(b.label AS VARCHAR) AS b
         FROM embeddings a JOIN embeddings b ON b.label = a.label + 1),
  w AS (SELECT a AS src, b AS dst FROM pr UNION SELECT b, a FROM pr),
  s AS (SELECT w.src, w.dst, p.x, p.y, p.z, COUNT(*) AS n FROM w JOIN p ON p.uid = w.src GROUP BY ALL),
  m AS (SELECT s.src, s.dst, s.n, sqrt(min((s.x - q.x) * (s.x - q.x) + (s.y - q.y) * (s.y - q.y) + (s.z - q.z) * (s.z - q.z))) AS d
        FROM s JOIN (SELECT DISTINCT uid, x, y, z FROM p) q ON q.uid = s.dst GROUP BY s.src, s.dst, s.x, s.y, s.z, s.n),
  a AS (SELECT src, dst, SUM(d * n) / SUM(n) AS v FROM m GROUP BY src, dst)
  SELECT pr.a, pr.b, round(f.v, 6) AS a_to_b, round(g.v, 6) AS b_to_a, round(f.v + g.v, 6) AS chamfer
  FROM pr JOIN a f ON f.src = pr.a AND f.dst = pr.b JOIN a g ON g.src = pr.b AND g.dst = pr.a
""")
def q_chamfer(spark, sf_dir):
    """Each label's point cloud against the next label's."""
    labels = table(spark, sf_dir, "embeddings").select("label").distinct()
    pairs = labels.join(labels.select((F.col("label") - 1).alias("label"), F.col("label").alias("next")), "label").select(
        F.col("label").cast("string").alias("a"), F.col("next").cast("string").alias("b"))
    out = ev.chamfer(_points(spark, sf_dir), pairs)
    return out.select("a", "b", *[F.round(c, ROUND).alias(c) for c in ("a_to_b", "b_to_a", "chamfer")])


_MATCH_SQL = """
  n AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda c: c * c))) AS l FROM embeddings),
  m AS (SELECT q.vec_id AS query, c.vec_id AS match, round(list_dot_product(q.v, c.v) / (q.l * c.l), 7) AS score, q.label = c.label AS hit
        FROM n q JOIN n c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND q.l > 0 AND c.l > 0 AND len(q.v) = len(c.v)),
  r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, match) AS rank FROM m QUALIFY rank <= 10)"""


def _matches(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ev.top_matches(e.where("vec_id % 100 = 0"), e, 10, digits=7)


@query("retrieval_matches", "R04", oracle=f"""
  WITH {_MATCH_SQL} SELECT query, CAST(rank AS INTEGER) AS rank, match, score FROM r
""")
def q_retrieval_matches(spark, sf_dir):
    return _matches(spark, sf_dir)


@query("retrieval_metrics", "R04", oracle=f"""
  WITH {_MATCH_SQL}, f AS (SELECT query, min(rank) FILTER (WHERE hit) AS first FROM r GROUP BY query)
  SELECT COUNT(*) AS n_queries, round(avg(CASE WHEN first IS NULL THEN 0.0 ELSE 1.0 END), 6) AS recall,
         round(avg(coalesce(1.0 / first, 0.0)), 6) AS mrr FROM f
""")
def q_retrieval_metrics(spark, sf_dir):
    out = ev.retrieval_metrics(_matches(spark, sf_dir), table(spark, sf_dir, "embeddings").select("vec_id", "label"))
    return out.select("n_queries", F.round("recall", ROUND).alias("recall"), F.round("mrr", ROUND).alias("mrr"))


@query("run_comparison", "R06 X11", oracle="""
  WITH m AS (SELECT 'run-' || (label % 5) AS run_id, CAST(vec_id % 7 AS INTEGER) AS step, round(avg(abs(CAST(embedding[1] AS DOUBLE))), 6) AS value
             FROM embeddings GROUP BY ALL),
  b AS (SELECT run_id, COUNT(*) AS n_steps, first(step ORDER BY value, step) AS best_step, min(value) AS best,
               last(value ORDER BY step) AS last FROM m GROUP BY run_id)
  SELECT run_id, n_steps, best_step, best, last, CAST(rank() OVER (ORDER BY best) AS INTEGER) AS place FROM b
""")
def q_run_comparison(spark, sf_dir):
    """Mean size of the first entry as a run's metric: runs by label, steps by vector."""
    e = table(spark, sf_dir, "embeddings")
    m = e.groupBy(F.concat(F.lit("run-"), (F.col("label") % 5).cast("string")).alias("run_id"),
                  (F.col("vec_id") % 7).cast("int").alias("step")).agg(
        F.round(F.avg(F.abs(F.element_at("embedding", 1).cast("double"))), 6).alias("value"))
    return ev.compare_runs(m.withColumn("key", F.lit("size")), "size")
