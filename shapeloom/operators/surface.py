"""Closed iso-surfaces of sparse grids, by the dual of the crossed grid edges.

Samples at or above the level are inside. Every grid edge from an inside
sample to one that isn't is crossed once, at the place where the value along
it meets the level. Each cube of eight samples with a crossed edge has one
vertex, the mean of its edges' crossing points, and each crossed edge is a
quad of the vertices of the four cubes around it. No table of cases is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import voxels as vx

AXES = vx.AXES
#: The cubes around an edge along an axis, as steps from the edge's lower end along the
#: two other axes, in turning order seen against the axis.
_AROUND = ((-1, -1), (0, -1), (0, 0), (-1, 0))
CUBE = ("i", "j", "k")


def at_cells(rows: DataFrame, cells: DataFrame, key: str, at: list[str], outer: bool = False) -> DataFrame:
    """``rows`` with what ``cells`` hold at the same key and place (``outer``: also rows without a cell); null keys and places have none.

    As a join by the key and ``at``, but rows and cells are grouped by them: a
    grouping takes tables laid out by the key alone as they are, where a join
    by more than the key sends both sides once more.
    """
    mine, theirs = ([c for c in d.columns if c not in (key, *at)] for d in (rows, cells))
    both = rows.select(key, *at, F.struct(*mine).alias("_r")).unionByName(
        cells.select(key, *at, F.struct(*theirs).alias("_c")), allowMissingColumns=True)
    met = both.groupBy(key, *at).agg(F.collect_list("_r").alias("_r"), F.collect_list("_c").alias("_c"))
    each = met.select(key, *at, F.explode("_r").alias("_r"), "_c")
    each = each.select(key, *at, "_r", (F.explode_outer if outer else F.explode)("_c").alias("_c"))
    return each.select(key, *at, *[F.col(f"_r.{c}").alias(c) for c in mine], *[F.col(f"_c.{c}").alias(c) for c in theirs])


def crossed_edges(cells: DataFrame, level: float | Column = 0.5, key: str = "uid") -> DataFrame:
    """``(key, x, y, z, face, axis, ex, ey, ez, px, py, pz)``: every crossed edge once.

    ``x, y, z`` is the inside sample, ``face`` the side on which it is crossed,
    ``ex, ey, ez`` the edge's lower end and ``p*`` the crossing point. Samples
    without a cell count as 0 and as outside; where the level is not above 0
    such an edge is crossed half way. ``level`` may be a column of ``cells``.
    """
    lv = level if isinstance(level, Column) else F.lit(float(level))
    base = cells.select(key, *[F.col(a).cast("int").alias(a) for a in AXES],
                        F.col("value").cast("double").alias("value"), lv.cast("double").alias("_t"))
    base = base.dropna(subset=[key, *AXES])
    faces = vx.boundary_faces(base, key, occupied=F.col("value") >= F.col("_t"))
    # a border holds far fewer samples than the grid: its values are looked up, not sent along every edge
    sign = F.when(F.substring("face", 1, 1) == "+", 1).otherwise(-1)
    steps = [F.when(F.substring("face", 2, 1) == a, sign).otherwise(0) for a in AXES]
    own = at_cells(faces, base, key, list(AXES)).withColumns({f"n{a}": F.col(a) + s for a, s in zip(AXES, steps)})
    beyond = base.select(key, *[F.col(a).alias(f"n{a}") for a in AXES], F.col("value").alias("_b"))
    both = at_cells(own, beyond, key, [f"n{a}" for a in AXES], outer=True)
    t, a, b = F.col("_t"), F.col("value"), F.coalesce("_b", F.lit(0.0))
    part = F.when(F.col("_b").isNull() & (t <= 0), F.lit(0.5)).otherwise((t - a) / (b - a))
    return both.select(
        key, *AXES, "face", F.substring("face", 2, 1).alias("axis"),
        *[F.least(c, f"n{c}").alias(f"e{c}") for c in AXES],
        *[(F.col(c) + (F.col(f"n{c}") - F.col(c)) * part).alias(f"p{c}") for c in AXES])


def dual_surface(cells: DataFrame, level: float | Column = 0.5, key: str = "uid") -> tuple[DataFrame, DataFrame]:
    """``(vertices, triangles)`` of the surface at ``level`` (see the module's text).

    vertices: key, the cube ``i, j, k`` (its lowest corner), ``x, y, z``.
    triangles: key, ``fid`` (two share a crossed edge), and the cubes of the
    three corners, ``ai .. ck``, counter-clockwise seen from outside.

    Every directed side of a triangle is met by the opposite side of another,
    so the surface is closed: a side belongs to two triangles, or to four where
    two sheets touch along it. Grids of any size, one per key; a key without
    inside samples has no rows. The caller must leave out non-finite values (F14).
    """
    edges = crossed_edges(cells, level, key)
    e = {a: F.col(f"e{a}") for a in AXES}
    cubes = []
    for u, v in _AROUND:
        # along x the other axes are y, z; along y they are z, x; along z they are x, y
        step = {"x": {"y": u, "z": v}, "y": {"z": u, "x": v}, "z": {"x": u, "y": v}}
        at = [e[c] + F.when(F.col("axis") == "x", step["x"].get(c, 0)).when(F.col("axis") == "y", step["y"].get(c, 0))
              .otherwise(step["z"].get(c, 0)) for c in AXES]
        cubes.append(F.struct(*[x.alias(n) for x, n in zip(at, CUBE)]))
    quads = edges.select(key, "face", "px", "py", "pz", F.xxhash64(F.col(key), "axis", "ex", "ey", "ez").alias("fid"), *[
        c.alias(f"c{n}") for n, c in enumerate(cubes)])
    corners = quads.select(key, "px", "py", "pz", F.explode(F.array(*[F.col(f"c{n}") for n in range(4)])).alias("c"))
    vertices = corners.groupBy(key, *[F.col(f"c.{n}").alias(n) for n in CUBE]).agg(
        *[F.avg(f"p{a}").alias(a) for a in AXES])
    out = F.substring("face", 1, 1) == "+"
    turned = [F.when(out, F.col(f"c{n}")).otherwise(F.col(f"c{m}")) for n, m in ((0, 0), (1, 3), (2, 2), (3, 1))]
    pair = F.array(F.struct(turned[0].alias("a"), turned[1].alias("b"), turned[2].alias("c")),
                   F.struct(turned[0].alias("a"), turned[2].alias("b"), turned[3].alias("c")))
    triangles = quads.select(key, "fid", F.explode(pair).alias("t")).select(
        key, "fid", *[F.col(f"t.{p}.{n}").alias(f"{p}{n}") for p in "abc" for n in CUBE])
    return vertices, triangles
