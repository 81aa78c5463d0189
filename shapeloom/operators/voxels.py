"""Voxel operators over the sparse long ``cells(uid, x, y, z, value)`` table.

V01-V19, F13-F15, A10, A11, J09, J10. Grids are never materialised densely
inside a job: a 32^3 grid is 32,768 cells while a shape occupies a few
thousand, so every operator works on occupied cells and treats absent cells as
0. Per-asset statistics are small aggregates joined back by ``uid`` (never a
``Window.partitionBy(uid)``, which would put one huge mesh into one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import failure_reason
from ..functions.vectors import scatter_dense

SHAPES = ("cube", "sphere", "cylinder")
AXES = ("x", "y", "z")


def _index_type(size: int) -> str:
    return "tinyint" if size <= 128 else "int"


def by_key(df: DataFrame, key: str = "uid", rows: int = 500) -> DataFrame:
    """``df`` with a key's rows in one task, in so many tasks that each has about ``rows`` rows (which are counted).

    For tables with a row per asset, before their cells are exploded: what
    groups the cells by the key and more, or joins them by it, then finds them
    together, and no cell is sent anywhere.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-df.count() // rows)), key)


# --------------------------------------------------------------------------- V01
def shape_cells(assets: DataFrame, size: int = 32, shape_col: str = "category",
                jitter_col: str = "jitter", key: str = "uid") -> DataFrame:
    """Occupied cells of the synthetic solids.

    Each asset row explodes only the cells of its own bounding box (no cross
    join with a full ``size^3`` range) and keeps the ones inside the solid, in
    one codegen stage; nothing dense is ever shuffled.
    """
    c = (size - 1) / 2.0
    shape = F.col(shape_col)
    j = F.col(jitter_col).cast("double")
    r = F.lit(size * 0.28) + j * 0.25
    half = F.greatest(F.lit(3), (F.lit(size * 0.24) + j * 0.1).cast("int")).cast("double")
    ext_xy = F.when(shape == "cube", half).otherwise(r)
    ext_z = (F.when(shape == "cube", half).when(shape == "cylinder", F.lit(size * 0.28))
             .otherwise(r))
    checked = F.when(shape.isin(*SHAPES), shape).otherwise(
        F.raise_error(F.concat(F.lit("Unsupported synthetic shape: "), F.coalesce(shape, F.lit("NULL")))))

    def span(ext: Column) -> Column:
        lo = F.greatest(F.lit(0), F.ceil(F.lit(c) - ext).cast("int"))
        hi = F.least(F.lit(size - 1), F.floor(F.lit(c) + ext).cast("int"))
        return F.sequence(lo, F.greatest(hi, lo - 1))

    base = assets.select(F.col(key), checked.alias("_s"), r.alias("_r"), half.alias("_h"),
                         ext_xy.alias("_exy"), ext_z.alias("_ez"))
    gx = base.withColumn("x", F.explode(span(F.col("_exy"))))
    gy = gx.withColumn("y", F.explode(span(F.col("_exy"))))
    gz = gy.withColumn("z", F.explode(span(F.col("_ez"))))
    dx, dy, dz = (F.col(a) - F.lit(c) for a in AXES)
    rr = F.col("_r") * F.col("_r")
    inside = (F.when(F.col("_s") == "sphere", dx * dx + dy * dy + dz * dz <= rr)
              .when(F.col("_s") == "cylinder", (dx * dx + dy * dy <= rr) & (F.abs(dz) <= size * 0.28))
              .otherwise((F.abs(dx) <= F.col("_h")) & (F.abs(dy) <= F.col("_h"))
                         & (F.abs(dz) <= F.col("_h"))))
    it = _index_type(size)
    return gz.where(inside).select(F.col(key), *[F.col(a).cast(it).alias(a) for a in AXES],
                                   F.lit(1.0).cast("float").alias("value"))


# ---------------------------------------------------------------------- V02/V03
def mesh_bounds(points: DataFrame, key: str = "uid") -> DataFrame:
    """Per-mesh min, max, extents and max extent (a small aggregate)."""
    aggs = []
    for a in AXES:
        aggs += [F.min(a).alias(f"min_{a}"), F.max(a).alias(f"max_{a}")]
    b = points.groupBy(key).agg(F.count(F.lit(1)).alias("n_points"), *aggs)
    ext = [(F.col(f"max_{a}") - F.col(f"min_{a}")).alias(f"ext_{a}") for a in AXES]
    b = b.select("*", *ext)
    return b.withColumn("max_extent", F.greatest(*[F.col(f"ext_{a}") for a in AXES]))


def mesh_checks(bounds: DataFrame, path_col: str | None = None, key: str = "uid") -> DataFrame:
    """``reason`` is NULL for a usable mesh, else ``ValueError: Empty mesh: ..``
    (no points) or ``ValueError: Degenerate mesh: ..`` (max extent <= 0)."""
    path = F.col(path_col) if path_col else F.col(key)
    reason = (F.when(F.coalesce(F.col("n_points"), F.lit(0)) == 0,
                     failure_reason("ValueError", F.concat(F.lit("Empty mesh: "), path)))
              .when(F.col("max_extent") <= 0,
                    failure_reason("ValueError", F.concat(F.lit("Degenerate mesh: "), path))))
    return bounds.withColumn("reason", reason)


# ------------------------------------------------------------------------ V04a
def voxelize_points(points: DataFrame, voxel_size: float = 0.05, key: str = "uid") -> DataFrame:
    """Scale each mesh to unit max extent and bin its points.

    index = floor((p - min) / max_extent / voxel_size + 0.5): the grid origin
    sits half a voxel below the scaled minimum. Meshes failing F13 are dropped
    (see :func:`mesh_checks` for their failure rows). Returns distinct cells.
    """
    b = mesh_bounds(points, key).where(F.col("max_extent") > 0)
    b = b.select(key, "max_extent", *[F.col(f"min_{a}") for a in AXES])
    j = points.join(b, key)
    idx = [F.floor((F.col(a) - F.col(f"min_{a}")) / F.col("max_extent") / F.lit(voxel_size)
                   + F.lit(0.5)).cast("int").alias(a) for a in AXES]
    return j.select(F.col(key), *idx).distinct()


# ------------------------------------------------------------------------ V04b
def _dot(a, b):
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _cross(a, b):
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def _separating_axes(a, b, c, h: float) -> Column:
    """What a cell of half width ``h`` is tested against, once per triangle: five numbers for each of ten axes.

    They are the axis, and the least and greatest projection of corner ``a``
    from the cell's centre at which triangle and cell meet along it. The axes
    are the edges' cross products with the grid axes and the triangle's
    normal; the grid axes themselves are what the triangle's box is cut by.
    """
    e = [tuple(q[k] - p[k] for k in range(3)) for p, q in ((a, b), (b, c), (c, a))]
    one = [tuple(F.lit(1.0 if k == j else 0.0) for k in range(3)) for j in range(3)]
    numbers = []
    for axis in [_cross(u, ed) for u in one for ed in e] + [_cross(e[0], e[1])]:
        rad = F.lit(h) * (F.abs(axis[0]) + F.abs(axis[1]) + F.abs(axis[2]))
        to_b, to_c = _dot(axis, e[0]), -_dot(axis, e[2])
        numbers += [*axis, -rad - F.greatest(F.lit(0.0), to_b, to_c), rad - F.least(F.lit(0.0), to_b, to_c)]
    return F.array(*numbers)


def voxelize_triangles(triangles: DataFrame, voxel_size: float = 0.05, key: str = "uid") -> DataFrame:
    """Every cell a triangle touches, on the unit-scaled mesh.

    Per mesh bounds come from a small aggregate over the three corners. A
    triangle's separating axes are worked out once; it explodes the cells of
    its own bounding box and keeps those that no axis parts from it, a dot
    product and two comparisons an axis; ``distinct`` combines map-side. Work is distributed by triangle, so one huge mesh is
    spread over many tasks.
    """
    corners = triangles.select(key, F.explode(F.array(
        *[F.struct(*[F.col(f"{p}{a}").alias(a) for a in AXES]) for p in "abc"])).alias("v"))
    pts = corners.select(key, *[F.col(f"v.{a}").alias(a) for a in AXES])
    b = mesh_bounds(pts, key).where(F.col("max_extent") > 0)
    b = b.select(key, "max_extent", *[F.col(f"min_{a}") for a in AXES])
    t = triangles.join(b, key)
    # scaled coordinates relative to the grid origin (min - half voxel), in voxel units
    rel = {}
    for p in "abc":
        for a in AXES:
            rel[p + a] = ((F.col(f"{p}{a}") - F.col(f"min_{a}")) / F.col("max_extent")
                          / F.lit(voxel_size) + F.lit(0.5))
    t = t.select(key, *[rel[k].alias("r" + k) for k in rel])
    corner = {p: tuple(F.col(f"r{p}{a}") for a in AXES) for p in "abc"}
    spans = [F.sequence(*[F.floor(f(*[F.col(f"r{p}{a}") for p in "abc"])).cast("int") for f in (F.least, F.greatest)])
             for a in AXES]
    t = t.select(key, *[F.col(f"ra{a}") for a in AXES], _separating_axes(*corner.values(), h=0.5).alias("_s"),
                 *[s.alias(f"_{a}") for s, a in zip(spans, AXES)])
    for a in AXES:
        t = t.withColumn(a, F.explode(f"_{a}")).drop(f"_{a}")
    at = [F.col(f"ra{a}") - (F.col(a) + F.lit(0.5)) for a in AXES]
    hit = F.lit(True)
    for n in range(0, 50, 5):
        p = F.col("_s")[n] * at[0] + F.col("_s")[n + 1] * at[1] + F.col("_s")[n + 2] * at[2]
        hit = hit & p.between(F.col("_s")[n + 3], F.col("_s")[n + 4])
    return t.where(hit).select(key, *AXES).distinct()


# ----------------------------------------------------------------- V05/V06/V10
def shift_to_origin(cells: DataFrame, key: str = "uid") -> DataFrame:
    """Subtract each asset's minimum index; add the source shape."""
    agg = [F.min(a).alias(f"_lo_{a}") for a in AXES] + [F.max(a).alias(f"_hi_{a}") for a in AXES]
    s = cells.groupBy(key).agg(*agg)
    j = cells.join(s, key)
    return j.select(key, *[(F.col(a) - F.col(f"_lo_{a}")).cast("int").alias(a) for a in AXES],
                    *[(F.col(f"_hi_{a}") - F.col(f"_lo_{a}") + 1).cast("int").alias(f"n_{a}")
                      for a in AXES])


def source_shape(cells: DataFrame, key: str = "uid") -> DataFrame:
    """V06 alone: ``max index + 1`` per axis (no shift)."""
    return cells.groupBy(key).agg(*[(F.max(a) + 1).cast("int").alias(f"n_{a}") for a in AXES])


def nearest_lookup(sizes: DataFrame, target: int = 32) -> DataFrame:
    """V10/J09 lookup ``(n, i, o)``: output index ``o`` of a ``target``-long axis
    reads input index ``i = floor(o*(n-1)/(target-1) + 0.5)`` of an ``n``-long
    axis (spline order 0). Built only for the lengths that occur."""
    if target < 2:
        raise ValueError("target must be >= 2")
    n = F.col("n")
    return (sizes.select(n).distinct()
            .select(n, F.explode(F.sequence(F.lit(0), F.lit(target - 1))).alias("o"))
            .select(n, F.when(n <= 1, F.lit(0)).otherwise(
                F.floor(F.col("o") * (n - 1) / F.lit(target - 1) + F.lit(0.5))).cast("int").alias("i"),
                F.col("o").cast("int")))


def nearest_range(i: Column, n: Column, target: int) -> tuple[Column, Column]:
    """Inverse of :func:`nearest_lookup`: the output indices ``o`` that read
    input index ``i`` of an ``n``-long axis form one contiguous range.

    ``i = floor(o*(n-1)/(T-1) + 1/2)`` holds exactly when
    ``(2i-1)(T-1) <= 2o(n-1) < (2i+1)(T-1)``, so
    ``o`` runs from ``ceil((2i-1)(T-1) / (2(n-1)))`` to
    ``ceil((2i+1)(T-1) / (2(n-1))) - 1``, clipped to ``[0, T-1]``; an axis of
    length 1 spreads its only index over the whole target. The bounds are
    ratios of small integers, far from rounding trouble in doubles.
    """
    t1 = F.lit(target - 1)
    den = (F.lit(2) * (n - 1)).cast("double")
    lo = F.ceil((F.lit(2) * i - 1) * t1 / den)
    hi = F.ceil((F.lit(2) * i + 1) * t1 / den) - 1
    lo = F.when(n <= 1, F.lit(0)).otherwise(F.greatest(lo, F.lit(0))).cast("int")
    hi = F.when(n <= 1, t1).otherwise(F.least(hi, t1)).cast("int")
    return lo, hi


def resize_nearest(cells: DataFrame, target: int = 32, key: str = "uid", shift: bool = True) -> DataFrame:
    """V05-V11 (V12 with ``shift=False``): stretch each axis independently to
    ``target`` cells by nearest neighbour, crop to the target (V11).

    One per-asset aggregate gives the minimum index and source shape (joined
    back on the key). Each cell then expands, axis by axis, into the closed
    range of output indices that read it (:func:`nearest_range`): a narrow
    explode, so no lookup table, broadcast or extra shuffle is needed. ``cells``
    is read twice (aggregate, join), so persist it first when it is expensive.
    """
    if target < 2:
        raise ValueError("target must be >= 2")
    agg = [F.min(a).alias(f"_lo_{a}") for a in AXES] + [F.max(a).alias(f"_hi_{a}") for a in AXES]
    shp = cells.groupBy(key).agg(*agg)
    lo = {a: (F.col(f"_lo_{a}") if shift else F.lit(0)) for a in AXES}
    shp = shp.select(key, *[lo[a].cast("int").alias(f"_lo_{a}") for a in AXES],
                     *[(F.col(f"_hi_{a}") - lo[a] + 1).cast("int").alias(f"n_{a}") for a in AXES])
    s = cells.join(shp, key).select(key, *[(F.col(a) - F.col(f"_lo_{a}")).cast("int").alias(a) for a in AXES],
                                    *[f"n_{a}" for a in AXES])
    bounds = []
    for a in AXES:
        r_lo, r_hi = nearest_range(F.col(a), F.col(f"n_{a}"), target)
        bounds += [r_lo.alias(f"_a_{a}"), r_hi.alias(f"_b_{a}")]
    r = s.select(key, *bounds)
    # a cell no output index reads (down-sampling) is dropped before any explode
    r = r.where((F.col("_a_x") <= F.col("_b_x")) & (F.col("_a_y") <= F.col("_b_y"))
                & (F.col("_a_z") <= F.col("_b_z")))
    for a in AXES:
        r = r.withColumn(f"o_{a}", F.explode(F.sequence(F.col(f"_a_{a}"), F.col(f"_b_{a}"))))
    it = _index_type(target)
    return r.select(key, *[F.col(f"o_{a}").cast(it).alias(a) for a in AXES],
                    F.lit(1.0).cast("float").alias("value"))


# ------------------------------------------------------------------ V13 dense
def dense_entries(cells: DataFrame, size: int = 32, key: str = "uid") -> DataFrame:
    """V13 gather: ``(key, _e)`` with ``_e`` the ``(k, v)`` entries of a grid sorted
    by the C-order index ``x*size^2+y*size+z`` (at most ``size^3`` per asset, and
    only occupied cells, so it stays small enough to join before densifying)."""
    flat = (F.col("x").cast("int") * size * size + F.col("y").cast("int") * size
            + F.col("z").cast("int"))
    return cells.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct(flat.alias("k"), F.col("value").cast("float").alias("v")))).alias("_e"))


def densify(entries: Column, size: int = 32) -> Column:
    """V13 scatter: dense ``array<float>`` of ``size^3``; NULL entries (no grid) give zeros."""
    return scatter_dense(entries["k"], entries["v"], size ** 3)


def to_dense(cells: DataFrame, size: int = 32, key: str = "uid") -> DataFrame:
    """Sparse -> ``array<float>`` of ``size^3`` in C order ``x*size^2+y*size+z``.
    Gathers at most ``size^3`` cells per asset (export only)."""
    return dense_entries(cells, size, key).select(key, densify(F.col("_e"), size).alias("grid"))


def from_dense(grids: DataFrame, size: int = 32, key: str = "uid", grid_col: str = "grid",
               keep_zeros: bool | str = False, carry: list[str] = ()) -> DataFrame:
    """V13 inverse: ``posexplode`` a flat grid back to cells.

    Zeros are dropped, kept (``True``), or dropped but for the first cell of an
    all-zero grid (``"origin"``). ``carry`` names further columns to keep.
    """
    empty = F.forall(grid_col, lambda v: v == 0).alias("_empty")
    e = grids.select(key, *carry, empty, grid_col).select(key, *carry, "_empty", F.posexplode(grid_col).alias("_i", "value"))
    if keep_zeros == "origin":
        e = e.where((F.col("value") != 0) | (F.col("_empty") & (F.col("_i") == 0)))
    elif not keep_zeros:
        e = e.where(F.col("value") != 0)
    i = F.col("_i")
    it = _index_type(size)
    return e.select(key, (i / (size * size)).cast("int").cast(it).alias("x"),
                    ((i / size).cast("int") % size).cast(it).alias("y"),
                    (i % size).cast(it).alias("z"), F.col("value").cast("float").alias("value"), *carry)


# --------------------------------------------------------------- V14/F14/A11
def grid_stats(cells: DataFrame, size: int = 32, key: str = "uid") -> DataFrame:
    """Dense min/max (absent cells are 0), non-finite count, cell count."""
    v = F.col("value").cast("double")
    bad = F.isnan(v) | (F.abs(v) == float("inf"))
    s = cells.groupBy(key).agg(F.count(F.lit(1)).alias("n_cells"),
                               F.count_if(bad).alias("n_nonfinite"),
                               F.min(F.when(~bad, v)).alias("_vmin"), F.max(F.when(~bad, v)).alias("_vmax"))
    full = F.col("n_cells") >= size ** 3
    gmin = F.when(full, F.col("_vmin")).otherwise(F.least(F.col("_vmin"), F.lit(0.0)))
    gmax = F.when(full, F.col("_vmax")).otherwise(F.greatest(F.col("_vmax"), F.lit(0.0)))
    return s.select(key, "n_cells", "n_nonfinite", gmin.alias("grid_min"), gmax.alias("grid_max"))


def adaptive_level(stats: DataFrame, threshold: float | Column = 0.5) -> DataFrame:
    """The iso level per grid, and why a grid has no surface.

    If the grid lies entirely on one side of ``threshold`` the level moves to
    ``(min+max)/2``; ``reason`` is set for non-finite grids and grids with
    ``max <= min``.
    """
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    lo, hi = F.col("grid_min"), F.col("grid_max")
    level = F.when((hi <= t) | (lo >= t), (lo + hi) / 2.0).otherwise(t)
    reason = (F.when(F.col("n_nonfinite") > 0, F.lit("Voxel grid contains non-finite values"))
              .when(hi <= lo, F.lit("Voxel grid has no isosurface")))
    return stats.withColumn("level", F.when(reason.isNull(), level)).withColumn("reason", reason)


# ----------------------------------------------------------------- V15a/V15b

#: Cells of a column that one mask holds; bits 0 and 63 are the cells below and above.
MASK_CELLS = 62


def column_masks(cells: DataFrame, key: str = "uid") -> DataFrame:
    """``(key, x, y, zb, m)``: cells packed along z; bit ``i`` (1 to MASK_CELLS) of ``m`` is the cell at ``zb * MASK_CELLS + i - 1``."""
    z = F.col("z").cast("int")
    bit = F.expr(f"shiftleft(CAST(1 AS BIGINT), CAST(pmod(CAST(z AS INT), {MASK_CELLS}) + 1 AS INT))")
    return cells.select(key, F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"),
                        F.floor(z / MASK_CELLS).cast("int").alias("zb"), bit.alias("b")).groupBy(key, "x", "y", "zb").agg(
        F.bit_or("b").alias("m"))


def boundary_face_masks(cells: DataFrame, key: str = "uid", occupied: Column | None = None) -> DataFrame:
    """V15b in packed form: ``(key, x, y, z0, face, fm)``; bit ``i`` of ``fm``
    is the face of the cell at ``z0 + i``. Grids of any size.

    Each ``(uid, x, y)`` column is cut into blocks of ``MASK_CELLS`` cells, and
    a block's occupied cells become one mask (``bit_or`` over the cells as they
    are, combined map-side). Only blocks are sent on: to themselves, to the four
    neighbour columns, and, where their first or last cell is occupied, as a
    border bit to the block below or above. Faces along z are bit tests within
    the mask, faces along x and y compare it with the neighbours' masks.
    """
    occ = cells.where(occupied) if occupied is not None else cells
    cols = column_masks(occ, key)
    low, high = F.shiftleft(F.lit(1).cast("long"), 1), F.shiftleft(F.lit(1).cast("long"), MASK_CELLS)
    top = F.lit(_signed64(1 << (MASK_CELLS + 1))).cast("long")
    one = F.lit(1).cast("long")

    def send(tag, dx, dy, dz, mask):
        return F.struct(F.lit(tag).alias("t"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(dz).alias("dz"), mask.alias("m"))
    m = F.col("m")
    sends = F.array(*[send(t, dx, dy, 0, m) for t, dx, dy in ((0, 0, 0), (1, 1, 0), (2, -1, 0), (3, 0, 1), (4, 0, -1))],
                    send(5, 0, 0, 1, F.when(m.bitwiseAND(low) != 0, top)),
                    send(5, 0, 0, -1, F.when(m.bitwiseAND(high) != 0, one)))
    e = cols.select(key, "x", "y", "zb", F.explode(sends).alias("s")).where("s.m is not null")
    e = e.select(key, (F.col("x") - F.col("s.dx")).alias("x"), (F.col("y") - F.col("s.dy")).alias("y"),
                 (F.col("zb") - F.col("s.dz")).alias("zb"), F.col("s.t").alias("t"), F.col("s.m").alias("m"))
    # tag 1: mask of column x+1 arrives at x; tag 2: x-1; tag 3: y+1; tag 4: y-1; tag 5: border bits
    none = F.lit(0).cast("long")
    g = e.groupBy(key, "x", "y", "zb").agg(
        *[F.bit_or(F.when(F.col("t") == t, F.col("m")).otherwise(none)).alias(f"m{t}") for t in range(1, 5)],
        F.bit_or(F.when(F.col("t").isin(0, 5), F.col("m")).otherwise(none)).alias("m0"))
    own = F.lit(((1 << MASK_CELLS) - 1) << 1).cast("long")
    g = g.withColumn("m", F.col("m0").bitwiseAND(own)).where("m != 0")
    m = F.col("m")
    face_masks = {
        "+x": m.bitwiseAND(F.bitwise_not("m1")), "-x": m.bitwiseAND(F.bitwise_not("m2")),
        "+y": m.bitwiseAND(F.bitwise_not("m3")), "-y": m.bitwiseAND(F.bitwise_not("m4")),
        "+z": m.bitwiseAND(F.bitwise_not(F.shiftrightunsigned("m0", 1))),
        "-z": m.bitwiseAND(F.bitwise_not(F.shiftleft("m0", 1))),
    }
    fm = g.select(key, "x", "y", "zb", F.explode(F.array(*[
        F.struct(F.lit(f).alias("face"), v.alias("fm")) for f, v in face_masks.items()])).alias("f"))
    return fm.where(F.col("f.fm") != 0).select(key, "x", "y", (F.col("zb") * MASK_CELLS - 1).alias("z0"),
                                                 F.col("f.face").alias("face"), F.col("f.fm").alias("fm"))


def _signed64(v: int) -> int:
    return v - (1 << 64) if v >= (1 << 63) else v


# bits whose position has bit k set (k = 0..5): sum of set positions by popcounts
_POS_BIT_MASKS = [_signed64(sum(1 << p for p in range(64) if (p >> k) & 1)) for k in range(6)]


def mask_count_and_zsum(fm: Column) -> tuple[Column, Column]:
    """Number of set bits and the sum of their positions, without unpacking."""
    cnt = F.bit_count(fm).cast("long")
    zsum = None
    for k, mk in enumerate(_POS_BIT_MASKS):
        term = F.bit_count(fm.bitwiseAND(F.lit(mk).cast("long"))).cast("long") * (1 << k)
        zsum = term if zsum is None else zsum + term
    return cnt, zsum


def boundary_faces(cells: DataFrame, key: str = "uid", occupied: Column | None = None) -> DataFrame:
    """Faces ``(key, x, y, z, face)`` of occupied cells whose
    neighbour is not occupied: the packed masks of
    :func:`boundary_face_masks`, their set bits exploded."""
    fm = boundary_face_masks(cells, key, occupied)
    # set bits -> z: binary string reversed, one character per bit
    bits = fm.select(key, "x", "y", "z0", "face", F.posexplode(F.split(F.reverse(F.bin("fm")), "")).alias("i", "b"))
    return bits.where(F.col("b") == "1").select(key, "x", "y", (F.col("z0") + F.col("i")).cast("int").alias("z"), "face")


def crossing_vertices(cells: DataFrame, level: float | Column = 0.5, size: int = 32,
                      key: str = "uid") -> DataFrame:
    """Iso-surface vertices on grid edges that straddle ``level``.

    Every stored cell contributes to the 3 edges it starts and the 3 it ends;
    one aggregation per edge recovers both endpoint values (absent = 0), so
    no self-join is needed. A vertex sits at ``i + (t - a)/(b - a)`` along the
    edge's axis. Edges leaving the grid are not part of it.
    ``level`` may be a column already joined onto ``cells``.
    """
    lv = level if isinstance(level, Column) else F.lit(float(level))
    base = cells.select(key, *[F.col(a).cast("int").alias(a) for a in AXES],
                        F.col("value").cast("double").alias("v"), lv.alias("_t"))
    roles = []
    for k, ax in enumerate(AXES):
        roles.append(F.struct(F.lit(ax).alias("axis"), F.lit(0).alias("dx"), F.lit(0).alias("dy"),
                              F.lit(0).alias("dz"), F.lit(True).alias("lo")))
        off = [-1 if j == k else 0 for j in range(3)]
        roles.append(F.struct(F.lit(ax).alias("axis"), F.lit(off[0]).alias("dx"),
                              F.lit(off[1]).alias("dy"), F.lit(off[2]).alias("dz"),
                              F.lit(False).alias("lo")))
    e = base.select(key, *AXES, "v", "_t", F.explode(F.array(*roles)).alias("r"))
    e = e.select(key, F.col("r.axis").alias("axis"),
                 (F.col("x") + F.col("r.dx")).alias("x"), (F.col("y") + F.col("r.dy")).alias("y"),
                 (F.col("z") + F.col("r.dz")).alias("z"), F.col("r.lo").alias("lo"), "v", "_t")
    inside = ((F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("z") >= 0)
              & (F.when(F.col("axis") == "x", F.col("x") + 1).otherwise(F.col("x")) < size)
              & (F.when(F.col("axis") == "y", F.col("y") + 1).otherwise(F.col("y")) < size)
              & (F.when(F.col("axis") == "z", F.col("z") + 1).otherwise(F.col("z")) < size))
    g = e.where(inside).groupBy(key, "axis", *AXES).agg(
        F.coalesce(F.max(F.when(F.col("lo"), F.col("v"))), F.lit(0.0)).alias("a"),
        F.coalesce(F.max(F.when(~F.col("lo"), F.col("v"))), F.lit(0.0)).alias("b"),
        F.max("_t").alias("_t"))
    t = F.col("_t")
    cross = (F.col("a") >= t) != (F.col("b") >= t)
    frac = (t - F.col("a")) / (F.col("b") - F.col("a"))
    pos = [(F.col(a).cast("double") + F.when(F.col("axis") == a, frac).otherwise(F.lit(0.0))).alias(f"p{a}")
           for a in AXES]
    return g.where(cross).select(key, "axis", *AXES, *pos)


# -------------------------------------------------------------- V16-V19
def normalise_vertices(vertices: DataFrame, key: str = "uid") -> DataFrame:
    """Subtract the bounding-box centre, divide by the max extent if > 0."""
    b = mesh_bounds(vertices, key)
    cen = [((F.col(f"min_{a}") + F.col(f"max_{a}")) / 2.0).alias(f"_c_{a}") for a in AXES]
    b = b.select(key, "max_extent", *cen)
    j = vertices.join(b, key)
    scale = F.when(F.col("max_extent") > 0, F.col("max_extent")).otherwise(F.lit(1.0))
    rest = [c for c in vertices.columns if c not in (key, *AXES)]
    return j.select(key, *rest, *[((F.col(a) - F.col(f"_c_{a}")) / scale).alias(a) for a in AXES])


def centre_on_mean(vertices: DataFrame, key: str = "uid") -> DataFrame:
    """Subtract the vertex mean and scale to unit max extent (which a shift leaves as it is)."""
    m = vertices.groupBy(key).agg(
        *[F.avg(a).alias(f"_m_{a}") for a in AXES],
        F.greatest(*[F.max(a) - F.min(a) for a in AXES]).alias("_extent"))
    rest = [c for c in vertices.columns if c not in (key, *AXES)]
    scale = F.when(F.col("_extent") > 0, F.col("_extent")).otherwise(F.lit(1.0))
    return vertices.join(m, key).select(key, *rest, *[((F.col(a) - F.col(f"_m_{a}")) / scale).alias(a) for a in AXES])


def axis_slice(cells: DataFrame, axis: str = "x", index: int = 16, key: str = "uid") -> DataFrame:
    """The 2-D slice ``axis = index`` (pushed down as a filter)."""
    others = [a for a in AXES if a != axis]
    return cells.where(F.col(axis) == index).select(key, *others, "value")


def occupancy(cells: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Binarise at a threshold (absent cells stay 0)."""
    return cells.where(F.col("value") > threshold).withColumn("value", F.lit(1.0).cast("float"))
