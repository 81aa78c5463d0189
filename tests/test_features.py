"""Embedding features against FIXTURES §4 goldens and a row-wise formulation."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from shapeloom.operators import features as fe


def _embed(spark, texts, dim, hasher="blake2b"):
    df = spark.createDataFrame(list(enumerate(texts)), "uid long, t string")
    out = fe.hash_embed(df, "uid", "t", dim=dim, hasher=hasher).collect()
    return {r.uid: (np.array(r.embedding), r.spec) for r in out}


def test_hash_embed_goldens(spark):
    texts = ["a wooden chair", "a chair", "wooden", "-", "", None]
    got = _embed(spark, texts, 32)
    nz = lambda v: {i: round(float(x), 6) for i, x in enumerate(v) if x != 0}
    assert nz(got[0][0]) == {2: 1.0}
    assert nz(got[1][0]) == {} and len(got[1][0]) == 32  # all-cancelled row still present
    assert nz(got[2][0]) == {2: 1.0}
    assert nz(got[3][0]) == {7: 1.0}
    assert got[0][1].backend == "hash" and got[0][1].embedding_dim == 32
    e8 = _embed(spark, ["", None], 8)
    assert nz(e8[0][0]) == {7: -1.0} and nz(e8[1][0]) == {7: -1.0}
    c = 0.408248
    e64 = _embed(spark, ["a simple cube shaped 3d object"], 64)
    assert nz(e64[0][0]) == {39: -c, 41: c, 42: -c, 52: c, 55: c, 63: -c}


def test_hash_embed_is_deterministic_and_of_unit_length(spark):
    texts = ["Ünïcode 中文 text", "a a a b", "x-y-z 123", "THE the The", "  "]
    a = _embed(spark, texts, 256)
    b = _embed(spark, texts, 256)
    for i in range(len(texts)):
        assert np.array_equal(a[i][0], b[i][0])
        assert math.isclose(float(np.linalg.norm(a[i][0])), 1.0, rel_tol=1e-5)
    assert np.array_equal(a[3][0], _embed(spark, ["the"], 256)[0][0])  # one token, however often


def test_rows_with_an_equal_key_stay_apart_and_nothing_is_shuffled(spark):
    df = spark.createDataFrame([(0, "a wooden chair"), (0, "a simple cube shaped 3d object")], "uid long, t string")
    out = fe.hash_embed(df, "uid", "t", dim=64)
    assert out.count() == 2 and len({tuple(r.embedding) for r in out.collect()}) == 2
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_md5_forms_agree(spark):
    df = spark.createDataFrame([(0, "a wooden chair wooden"), (1, "b c d e"), (2, "")], "uid long, t string")
    grouped = {(r.uid, r.slot): r.w for r in fe.slot_weights(df, "uid", "t", 32, "md5").collect()}
    per_row = {(r.uid, e.slot): e.w for r in fe.row_weights(df, "uid", "t", 32, "md5").collect() for e in r._e}
    assert grouped == per_row


def test_l2_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<float>")
    assert [list(r.v) for r in df.select(fe.l2_normalise(df).alias("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_backend_dispatch(spark):
    df = spark.createDataFrame([(0, "a chair")], "uid long, description string")
    with pytest.raises(ValueError, match="Unknown text encoder backend"):
        fe.embed(df, backend="bert")

    def factory():
        def predict(texts):
            return np.stack([np.full(4, float(len(t)), dtype=np.float32) for t in texts])
        return predict

    out = fe.embed(df, backend="T5", factory=factory, dim=4, model_name="toy").first()
    assert list(out.embedding) == [7.0] * 4 and out.spec.backend == "t5"


def test_mean_pool_masked(spark):
    df = spark.createDataFrame([(0, 1, [1.0, 2.0]), (0, 0, [3.0, 4.0]), (1, 0, [5.0, 6.0])],
                               "k int, m int, embedding array<float>")
    plain = {(r.k, r.dim): r.value for r in fe.mean_pool(df, "k").collect()}
    masked = {(r.k, r.dim): r.value for r in fe.mean_pool(df, "k", mask=df.m == 1).collect()}
    assert plain[(0, 0)] == 2.0 and plain[(0, 1)] == 3.0
    assert masked[(0, 0)] == 1.0 and masked[(1, 0)] == 0.0  # all-masked -> 0/max(0,1)


def test_tokens_of_one_row_at_a_time(spark):
    """A batch's tokens are never all Python strings at once."""
    sums = fe._row_weights(64, "md5")()
    words = pa.array([[f"w{k % 5000:08d}" for k in range(1000)]] * 1000, pa.list_(pa.string()))
    sums(words[0].as_py())
    for make in (fe._weight_lists, lambda rows, sums: fe._vector_lists(rows, sums, 64)):
        tracemalloc.start()
        out = make(words, sums)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(out) == 1000 and peak < 12e6  # 1,000,000 tokens take 50 MB and more
    some = pa.array([["skip"], ["a", "b", "a"], [], None], pa.list_(pa.string())).slice(1)
    one, none, gone = fe._weight_lists(some, sums).to_pylist()
    assert {e["slot"]: e["w"] for e in one} == dict(sums(["a", "b", "a"])) and none == gone == [{"slot": s, "w": w} for s, w in sums([]).items()]
    assert fe._weight_lists(some.slice(0, 0), sums).to_pylist() == [] == fe._vector_lists(some.slice(0, 0), sums, 64).to_pylist()
