"""Whitening against numpy on whole tables, and its eigenpairs against known matrices."""

import math

import numpy as np
import pytest

from shapeloom.llm import whitening
from shapeloom.llm.eigen import leading_eigenpairs, sturm_counts, tridiagonal
from shapeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=4):
    """rows: (vec_id, list). -> {(vec_id, component): ...} by whole-matrix numpy, exact sums by Python ints."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array(fit, dtype=np.float64) - np.array(s) / n
    v = z.T @ z / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    out = []
    for i, x in kept:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s))
        white = (np.array(x) - np.array(s) / n) @ axes / np.sqrt(values)
        out += [(i, c + 1, n, deviation, white[c], values[c] / np.trace(v)) for c in range(len(values))]
    return out


def same(got, want):
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got), key=lambda r: r[:4])
    want = sorted(want, key=lambda r: r[:4])
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for c in {r[1] for r in want}:
        a = np.array([r[4] for r in got if r[1] == c])
        b = np.array([r[4] for r in want if r[1] == c])
        sign = np.sign(a[np.abs(a).argmax()] * b[np.abs(a).argmax()])
        assert np.abs(a - sign * b).max() < 1e-8
        e = next(r[5] for r in want if r[1] == c)
        assert all(abs(r[5] - e) <= 1e-10 * e for r in got if r[1] == c)


def test_query_equals_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op13_embedding_whitening"].build(spark, SF).collect()
    assert len(got) == 4 * len(rows) and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    same(got, brute(rows))


def test_bad_rows_copies_and_extra_columns(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1 + (i % 5), 6).tolist()) for i in range(60)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (100, None), (101, [1.0, None] + [0.0] * 4),
             (102, [float("nan")] + [0.0] * 5), (103, [float("inf")] + [0.0] * 5), (104, [])]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], SCHEMA + ", dim int, x string")
    got = whitening.whiten(df).collect()
    want = brute([r for r in rows if r[0] is not None and r[0] != 104])
    ghost = [r for r in got if r.vec_id is None]
    assert len(ghost) == 4 and {r.whitened for r in ghost} == {r.whitened for r in got if r.vec_id == 8}
    same([r for r in got if r.vec_id is not None], want)


def test_flat_short_and_mixed_lengths(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [1.0, 2.0, 3.0]), (4, [2.0, 2.0, 3.0])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (2, 2), *((v, c) for v in (3, 4) for c in (1, 2, 3))}
    assert got[1, 1].whitened is None and got[1, 1].explained is None and got[1, 1].n == 1 and got[1, 1].identity_error is None
    assert abs(got[3, 1].whitened) == pytest.approx(1) and got[3, 1].whitened == -got[4, 1].whitened
    assert got[3, 2].whitened is None and got[3, 1].explained == 1 and got[3, 1].deviation == 256 ** 2
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [2.0 ** 40, 0.0])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = [[whitening.LONG_MAX, 0], [whitening.LONG_MIN, 256], [2 ** 48, 0]]
    s = [sum(c) for c in zip(*x)]
    for i, v in enumerate(x):
        exact = sum((3 * a - b) ** 2 for a, b in zip(v, s))
        assert got[i + 1, 1].deviation is None and got[i + 1, 1].deviation_text == str(exact)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_eigenpairs_of_random_matrices(n):
    x = np.random.default_rng(n).standard_normal((2 * n, n))
    a = x.T @ x
    values, axes = leading_eigenpairs(a, 4)
    k = min(4, n)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-12 * np.abs(a).sum()
    assert np.abs(a @ axes - axes * values).max() < 1e-12 * np.abs(a).sum()
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-12


@pytest.mark.parametrize("spectrum", [[3] * 9, [5, 5, 5, 1, 0], [1, 1 - 1e-9, 1 - 1e-6, 0.5, 0.1], [1e-200] * 3, [0, 0]])
def test_eigenpairs_of_clusters(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((len(spectrum),) * 2))
    a = (q * np.array(spectrum, dtype=float)) @ q.T
    a = (a + a.T) / 2
    values, axes = leading_eigenpairs(a, 4)
    top = max(max(spectrum), 1e-300)
    assert np.abs(values - spectrum[:4]).max() <= 1e-13 * top
    assert np.abs(a @ axes - axes * values).max() <= 1e-13 * top
    assert np.abs(axes.T @ axes - np.eye(axes.shape[1])).max() < 1e-12


def test_tridiagonal_form_and_sturm_counts():
    a = np.random.default_rng(5).standard_normal((12, 12))
    a = a + a.T
    d, e, q = tridiagonal(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.abs(q @ t @ q.T - a).max() < 1e-12 and np.abs(q.T @ q - np.eye(12)).max() < 1e-13
    at = np.linspace(-8, 8, 50)
    assert sturm_counts(d, e, at).tolist() == [(np.linalg.eigvalsh(a) < x).sum() for x in at]
