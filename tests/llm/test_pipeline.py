"""Every stage of the pipeline against the brute-force version of its operator."""

import re

import test_decontaminate
import test_line_dedup
import test_mixing
import test_near_dedup
from pyspark.sql import functions as F

import corpus_pipeline as cp
from shapeloom.llm.storage import run_dir, written

SF = "/root/testdata/sf0.01"


def test_stages_equal_brute_force(spark):
    folder = run_dir(spark, "pipeline-test")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for k, (_, stage) in enumerate(cp.STAGES):
        docs = written(stage(spark, docs, SF), folder, str(k))
        out.append(docs)
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in out[:4]]
    assert all(d.columns == cp.COLUMNS for d in out[:4])

    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {d for d, _ in rows[0]}
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(d in kept for d in clean) > 0.97 * len(clean)
    bad = [d for d, r in labels.items() if r.toxic == 1 or r.quality == 0]
    assert sum(d in kept for d in bad) < 0.2 * len(bad)

    want = {(d, t) for d, t, n in test_line_dedup.brute(rows[0], 1) if not n or re.search(r"[^\x20\x09-\x0D]", t)}
    assert set(rows[1]) == want
    groups = test_near_dedup.brute(rows[1])
    assert set(rows[2]) == {(d, t) for d, t in rows[1] if groups[d][1] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, _ in test_decontaminate.brute(rows[2], items)}
    assert hit and set(rows[3]) == {(d, t) for d, t in rows[2] if d not in hit}
    assert all(r.n_chars == len(r.text) for r in out[1].collect())
    test_mixing.check(out[3])
    assert out[4].count() == out[3].count()


def test_nulls_empties_repeats_and_empty_tables(spark, tmp_path):
    good = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 3").select(*cp.COLUMNS)
    odd = spark.createDataFrame([(900, None, None, None, None), (901, "", "en", "s", 0), (None, "some words here", "en", "s", 15)],
                                good.schema)
    docs = good.union(good).union(odd).withColumn("component_id", F.lit(1)).withColumn("_n", F.lit(2))
    for _, stage in cp.STAGES[:4]:
        got = stage(spark, docs, SF)
        assert got.columns == cp.COLUMNS and got.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
    near = cp.dedup_near(spark, docs, SF)
    assert near.where("doc_id < 3").groupBy("doc_id").count().where("count > 1").isEmpty()
    assert cp.mix_sources(spark, docs, SF).count() == docs.count()


def test_near_dedup_keeps_unlike_texts_under_null_or_shared_ids(spark):
    def text(w):
        return " ".join(f"{w}{i}" for i in range(60))
    near = text("d") + " more"
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (8, near), (9, text("e"))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in cp.dedup_near(spark, docs, SF).collect()]
    want = [(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (9, text("e"))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
