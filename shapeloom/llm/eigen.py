"""Leading eigenpairs of a symmetric matrix, by bisection on its tridiagonal form.

Householder reflections bring the matrix to tridiagonal form, Sturm counts
bracket each wanted eigenvalue by bisection, and inverse iteration gives its
vector; vectors of eigenvalues that lie close together are kept orthogonal to
each other. The matrix has as many rows as the vectors have entries, so this
runs on the driver whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues nearer to each other than this share of the matrix' norm form a cluster.
CLUSTER = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with ``a = q T q'``."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        scale = np.abs(x[1:]).max(initial=0.0)
        if scale == 0.0:
            continue
        v = x / max(scale, abs(x[0]))
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        a[k + 1:, k:] -= 2.0 * np.outer(v, v @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ v, v)
        q[:, k + 1:] -= 2.0 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each place of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    least = max(tiny, np.finfo(float).eps * np.finfo(float).eps * float(np.abs(off).max(initial=0.0)) ** 2)
    below = np.zeros(len(at), dtype=np.int64)
    pivot = np.ones(len(at))
    for i, d in enumerate(diagonal):
        pivot = d - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected to the last bit."""
    n = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    pad = 4 * np.finfo(float).eps * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - pad, high + pad
    rank = n - np.arange(1, k + 1)  # so many eigenvalues lie below the wanted one
    while True:
        middle = 0.5 * (low + high)
        if np.all((middle <= low) | (middle >= high)):
            return middle
        under = sturm_counts(diagonal, off, middle) <= rank
        low, high = np.where(under, middle, low), np.where(under, high, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solve (T - shift) x = b by elimination with row exchanges; a zero pivot counts as ``least``."""
    n = len(diagonal)
    d, up, up2, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        low = off[i]
        if abs(low) > abs(d[i]):
            factor = d[i] / low
            d[i], up[i], d[i + 1], old = low, d[i + 1], up[i] - factor * d[i + 1], up[i + 1]
            if i + 2 < n:
                up2[i], up[i + 1] = old, -factor * old
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(d[i]) < least:
                d[i] = least
            factor = low / d[i]
            d[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    if abs(d[-1]) < least:
        d[-1] = least
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)) / d[i]
        if abs(x[i]) > 1e100:  # only the direction counts
            x *= 1e-100
    return x


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors as columns) of the ``k`` leading eigenpairs (all if fewer).

    Equal or nearly equal eigenvalues get vectors orthogonal to each other; an
    eigenvalue's sign of vector is fixed so that its largest entry is positive.
    A matrix of zeros has the first unit vectors. ``a`` is symmetric and finite.
    """
    a = np.asarray(a, dtype=np.float64)
    n = len(a)
    k = min(k, n)
    norm = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if k == 0 or norm == 0.0:
        return np.zeros(k), np.eye(n)[:, :k]
    diagonal, off, q = tridiagonal(a / norm)
    values = leading_values(diagonal, off, k)
    eps = np.finfo(float).eps
    vectors = np.zeros((n, k))
    rng = np.random.default_rng(1)
    for j, value in enumerate(values):
        first = j
        while first and values[first - 1] - values[first] <= CLUSTER:
            first -= 1
        near = vectors[:, first:j]
        # equal shifts would give one vector again: part them by a rounding error each
        shift = value - (j - first) * 4 * eps
        x = rng.standard_normal(n)
        for _ in range(6):
            x -= near @ (near.T @ x)
            x /= np.sqrt(x @ x)
            x = _solve(diagonal, off, shift, x, eps)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= near @ (near.T @ x)
            x /= np.sqrt(x @ x)
        vectors[:, j] = x
    vectors = q @ vectors
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(k)]
    return values * norm, vectors * np.where(largest < 0, -1.0, 1.0)
