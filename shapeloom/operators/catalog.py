"""Catalog operators: category index, metadata build, clean + keep-first dedupe.

S02 W02 J01 J04 F06 W03 L01-L04 P02 T04 F02 W01 A05 U02 U03.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx


def category_members(index: DataFrame) -> DataFrame:
    """``(category, uids[], cat_pos)`` -> ``(category, cat_pos, pos, uid)``.

    A bag: a uid listed under two categories appears twice. ``pos`` is the
    0-based position in the category's list, which is what ``limit`` slices;
    the flattened list is in order of ``(cat_pos, pos)``.
    """
    return index.select("category", "cat_pos", F.posexplode("uids").alias("pos", "uid"))


def check_limit(limit: int | None) -> int | None:
    """``None`` and ``0`` mean all rows; negative limits are rejected."""
    if limit is None or limit == 0:
        return None
    if limit < 0:
        raise ValueError(f"limit must be >= 0, got {limit}")
    return int(limit)


def select_categories(members: DataFrame, categories: Iterable[str] | None = None,
                      limit: int | None = None) -> DataFrame:
    """Members of the requested categories, first ``limit`` each.

    Unknown categories raise ``ValueError`` (the existence check reads at most
    one row per requested category).
    """
    out = members
    if categories is not None:
        cats = sorted(set(categories))
        out = out.where(F.col("category").isin(*cats))
        found = {r[0] for r in out.select("category").distinct().collect()}
        missing = [c for c in cats if c not in found]
        if missing:
            raise ValueError(f"Unknown Objaverse LVIS category: {missing[0]}")
    lim = check_limit(limit)
    if lim is not None:
        out = out.where(F.col("pos") < lim)
    return out


def first_per_category(rows: DataFrame, n: int, order: list[str], category: str = "category") -> DataFrame:
    """The first ``n`` rows of each category by ``order``, with their place as ``pos`` (from 0).

    The limit works within each task before anything is shuffled, so a category
    that holds most rows sends at most ``n`` of them from a task. Rows equal in
    ``order`` are placed in no certain order.
    """
    rank = F.row_number().over(Window.partitionBy(category).orderBy(*order))
    return rows.withColumn("pos", rank).where(F.col("pos") <= n).withColumn("pos", (F.col("pos") - 1).cast("long"))


def add_sanitized(df: DataFrame, text: Column, category: str, out: str) -> DataFrame:
    """Add T02 of already-clean ``text`` as ``out``, one projection per step."""
    keep = [c for c in df.columns if c != out]
    cur = df
    for name, expr in tx.sanitize_steps(text, F.col(category), prechecks=True):
        cur = cur.select(*keep, *[c for c in cur.columns if c.startswith("_s")], expr.alias(name))
    return cur.select(*keep, F.col("_out").alias(out))


def describe(df: DataFrame, category: str = "category", out: str = "description_raw") -> DataFrame:
    """T04 on a frame with ``name, description, tags, categories``: fragments ->
    joined clean text -> fallback -> T02, staged so no large expression is
    duplicated in the plan."""
    parts = tx.description_parts(F.col("name"), F.col("description"), F.col("tags"), F.col("categories"))
    base = [c for c in df.columns if c not in ("name", "description", "tags", "categories")]
    d = df.select(*base, tx.clean_text(F.array_join(parts, " ")).alias("_joined"))
    d = d.select(*base, F.when(F.col("_joined") == "", tx.fallback_description(F.col(category)))
                 .otherwise(F.col("_joined")).alias("_text"))
    return add_sanitized(d, F.col("_text"), category, out).drop("_text")


def category_metadata(members: DataFrame, annotations: DataFrame) -> DataFrame:
    """One ``description_raw`` per requested ``(category, pos, uid)``.

    Annotations hold one record per uid (a keyed store); only the requested
    uids survive the join, and a missing annotation still yields the fallback.
    """
    ann = annotations.select("uid", "name", "description", "tags", "categories")
    joined = members.select("uid", "category", *[c for c in ("cat_pos", "pos") if c in members.columns]).join(ann, "uid", "left")
    return describe(joined).select("uid", "category", *[c for c in ("cat_pos", "pos") if c in joined.columns], "description_raw")


def keep_first(df: DataFrame, key: str | list[str], order: str | list[str],
               where: Column | None = None) -> DataFrame:
    """Keep the first row of every key by ``order`` (deterministic),
    among the rows satisfying ``where`` (keys with no such row are dropped).

    Plans as a partial + final aggregate: duplicates of a hot key collapse
    map-side before the shuffle, so one key never lands whole in one task.
    The row filter lives inside the aggregate (``min`` skips NULL), so it is
    never pushed below, and evaluated apart from, the columns it tests.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys and c not in orders]
    packed = F.struct(*[F.col(c) for c in orders + rest])
    if where is not None:
        packed = F.when(where, packed)
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first")).where(F.col("_first").isNotNull())
    return agg.select(*keys, *[F.col("_first")[c].alias(c) for c in orders + rest]).select(*df.columns)


def clean_manifest(df: DataFrame, key: str = "uid", order: str | list[str] | None = None) -> DataFrame:
    """T03 + F02 + W01: add ``description``, drop empty ones, then keep first per key.

    F02 applies before W01, so a duplicate whose first row cleans to empty is
    represented by its next non-empty row. The order is ``(cat_pos, pos)``
    where the frame has a ``cat_pos``, else ``pos``.
    """
    order = order or [c for c in ("cat_pos", "pos") if c in df.columns]
    out = df.withColumn("description", tx.clean_description("description_raw"))
    return keep_first(out, key, order, where=F.length("description") > 0)


def _sizes(index: DataFrame) -> DataFrame:
    n = F.size("uids") if "uids" in index.columns else F.lit(1)
    return index.groupBy("category").agg(F.sum(n).alias("n_uids"), F.min("cat_pos").alias("cat_pos"))


def category_sizes(index: DataFrame) -> DataFrame:
    """Uid count per category, ranked by size (ties keep input order).

    ``index`` has one row per category (``uids``) or one per member, so a large
    category need not be gathered into an array; its least ``cat_pos`` breaks
    ties. The ranking window runs over one row per category.
    """
    sized = _sizes(index)
    w = Window.orderBy(F.col("n_uids").desc(), F.col("cat_pos"))
    return sized.withColumn("size_rank", F.row_number().over(w))


def largest_category(index: DataFrame) -> DataFrame:
    """The top category by size (first in input order on ties)."""
    return _sizes(index).orderBy(F.col("n_uids").desc(), F.col("cat_pos")).limit(1)


def first_n(df: DataFrame, n: int, order: str | list[str] = ("cat_pos", "pos")) -> DataFrame:
    """The first ``n`` rows of the flattened list, by explicit ordinals (top-k)."""
    return df.orderBy(*([order] if isinstance(order, str) else order)).limit(n)


SHAPES = ("cube", "sphere", "cylinder")


def synthetic_manifest(ids: DataFrame, id_col: str = "id", root: str = "data/processed") -> DataFrame:
    """The synthetic dataset's manifest rows for integer ids ``i``.

    ``shape = SHAPES[i % 3]``, ``uid = synthetic-{shape}-{i:04d}``,
    ``jitter = i % 5 - 2``; feature paths are logical keys ``{root}/voxels/{uid}.pt``.
    """
    i = F.col(id_col).cast("long")
    shape = F.element_at(F.array(*[F.lit(s) for s in SHAPES]), (i % 3 + 1).cast("int"))
    uid = F.format_string("synthetic-%s-%04d", shape, i)
    return ids.select(
        i.alias("i"),
        uid.alias("uid"),
        shape.alias("category"),
        F.concat(F.lit("a simple "), shape, F.lit(" shaped 3d object")).alias("description"),
        F.concat(F.lit(root + "/voxels/"), uid, F.lit(".pt")).alias("voxel_path"),
        F.concat(F.lit(root + "/embeddings/"), uid, F.lit(".pt")).alias("embedding_path"),
        F.lit("synthetic").alias("source"),
        (i % 5 - 2).cast("int").alias("jitter"),
    )


def notebook_descriptions(annotations: DataFrame, key: str = "uid",
                          stop_words: list[str] | None = None) -> DataFrame:
    """The research variant of the description.

    Only annotations with tags (F18); tag names joined by a space (T15); ASCII
    punctuation deleted, English stop words dropped *before* lower-casing
    (case-sensitive, so ``The`` survives), lower-cased (T14); empty results
    dropped (F17). ``stop_words`` defaults to Spark's own English list; stemming
    and lemmatisation are not part of the engine.
    """
    from pyspark.ml.feature import StopWordsRemover

    # each step is bound by an explode of one element, or of none for a row that goes: as a
    # filter over columns it would be pushed down, and the steps before it worked out twice
    each = lambda df, kept, value, name: df.select(key, F.explode(
        F.when(kept, F.array(value))).alias(name))
    t = each(annotations, F.size("tags") > 0, tx.strip_punctuation(tx.tag_text(F.col("tags"))), "_text")
    w = t.select(key, tx.split_words("_text").alias("_words"))
    remover = StopWordsRemover(inputCol="_words", outputCol="_kept", caseSensitive=True)
    kept = (remover.setStopWords(stop_words) if stop_words is not None else remover).transform(w)
    out = kept.select(key, F.explode(F.array(F.lower(F.array_join("_kept", " ")))).alias("description"))
    return out.where(F.col("description") != "")
