"""Catalog ordering, keep-first dedupe, limits, warehouse layer."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shapeloom import schemas
from shapeloom.operators import catalog as cat
from shapeloom.operators import quality as q
from shapeloom.operators.ordinal import global_ordinal, ordinal_within


def test_keep_first_after_empty_filter(spark):
    # duplicate uid whose first row cleans to empty: the next row survives
    df = spark.createDataFrame([("u", 0, "!!!"), ("u", 1, "Second"), ("u", 2, "Third"), ("v", 5, "x y")],
                               "uid string, pos long, description_raw string")
    got = {r.uid: (r.pos, r.description) for r in cat.clean_manifest(df).collect()}
    assert got == {"u": (1, "second"), "v": (5, "x y")}


@pytest.mark.parametrize("parts", [1, 7])
def test_ordinals_match_row_number(spark, parts):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1000).alias("o"))
    df = df.repartition(parts)
    got = ordinal_within(df, ["g"], ["o"], out="pos", num_partitions=5)
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert sorted(got.collect()) == sorted(ref.select("g", "o", F.col("pos").cast("long")).collect())
    g1 = global_ordinal(df.select("o").distinct(), ["o"], out="rn")
    assert sorted(r.rn for r in g1.collect()) == list(range(1, g1.count() + 1))


def test_category_members_limit_and_unknown(spark):
    idx = spark.createDataFrame([("chair", ["a", "b", "c"], 0), ("lamp", ["c", "d"], 1)], schemas.CATEGORY_INDEX)
    m = cat.category_members(idx)
    assert m.count() == 5  # a bag: 'c' appears twice
    two = cat.select_categories(m, ["chair"], limit=2)
    assert [r.uid for r in two.orderBy("pos").collect()] == ["a", "b"]
    assert cat.select_categories(m, ["chair"], limit=0).count() == 3
    with pytest.raises(ValueError, match="Unknown Objaverse LVIS category: sofa"):
        cat.select_categories(m, ["sofa"])
    with pytest.raises(ValueError):
        cat.select_categories(m, None, limit=-1)


def test_categories_have_one_input_order(spark):
    idx = spark.createDataFrame([("chair", ["a", "b", "u"], 0), ("sofa", ["u", "d"], 1)], schemas.CATEGORY_INDEX)
    m = cat.category_members(idx)
    assert [r.uid for r in cat.first_n(m, 4).collect()] == ["a", "b", "u", "u"]
    raw = m.withColumn("description_raw", F.concat(F.lit("A fine wooden "), "category"))
    kept = {r.uid: r.category for r in cat.clean_manifest(raw).collect()}
    assert kept == {"a": "chair", "b": "chair", "u": "chair", "d": "sofa"}  # the first in input order
    assert [(r.category, r.size_rank) for r in cat.category_sizes(idx).orderBy("size_rank").collect()] == [("chair", 1), ("sofa", 2)]
    assert cat.largest_category(idx).first().category == "chair"


def test_synthetic_manifest_rows(spark):
    m = cat.synthetic_manifest(spark.range(0, 3)).collect()
    assert [r.uid for r in m] == ["synthetic-cube-0000", "synthetic-sphere-0001", "synthetic-cylinder-0002"]
    assert m[1].description == "a simple sphere shaped 3d object" and m[0].jitter == -2
    big = cat.synthetic_manifest(spark.range(12345, 12346)).first()
    assert big.uid == "synthetic-cube-12345"


def test_staging_mart_and_tests(spark):
    nb = " "
    man = spark.createDataFrame([
        ("1", "Chair", "ok", "v1", "e1", "s"), (None, "chair", "x", "v", "e", "s"),
        ("2", "chair", nb + " ", None, "e2", "s"), ("2", "LAMP", None, "v3", None, "s")],
        "uid string, category string, description string, voxel_path string, embedding_path string, source string")
    st = q.stage_assets(man)
    assert st.columns == ["asset_id", "category", "description", "voxel_path", "embedding_path"]
    mart = {r.category: r for r in q.quality_mart(st).collect()}
    assert mart["chair"].asset_count == 2 and mart["chair"].missing_descriptions == 1
    assert mart["chair"].missing_voxels == 1 and mart["lamp"].missing_embeddings == 1
    tests = {(r.test, r.key): r.n_rows for r in q.column_tests(st).collect()}
    assert tests == {("unique", "2"): 2}
    with pytest.raises(ValueError, match="missing columns: \\['embedding_path'\\]"):
        q.check_manifest(man.drop("embedding_path"))
    with pytest.raises(ValueError, match="no rows"):
        q.check_manifest(man.limit(0))
