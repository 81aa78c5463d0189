"""Vector Column builders."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dense_from_sorted(entries: Column, n: int, fill=0.0, dtype: str = "float") -> Column:
    """Dense ``array`` of length ``n`` from ``array<struct<k,v>>`` sorted by distinct ``k``.

    Each entry emits the zero run since the previous key and then its value,
    so the cost is O(n) per row (a map lookup per slot would be O(n * entries)).
    """
    z = F.lit(fill).cast(dtype)
    prev_k = lambda j: F.when(j == 0, F.lit(-1)).otherwise(entries[j - 1]["k"])
    body = F.flatten(F.transform(entries, lambda e, j: F.concat(
        F.array_repeat(z, (e["k"] - prev_k(j) - 1).cast("int")), F.array(e["v"].cast(dtype)))))
    last = F.coalesce(F.element_at(entries, -1)["k"], F.lit(-1))
    tail = F.array_repeat(z, (F.lit(n - 1) - last).cast("int"))
    return F.when(entries.isNull() | (F.size(entries) == 0), F.array_repeat(z, n)) \
        .otherwise(F.concat(body, tail))


def scatter_dense(keys: Column, values: Column, n: int) -> Column:
    """Dense ``array<float>`` of length ``n`` with ``values`` at ``keys`` (0 elsewhere).

    An Arrow batch UDF: each row is one NumPy scatter, far cheaper than an
    element-by-element array lambda. Self-contained (NumPy/pandas only).
    """
    @F.pandas_udf("array<float>")
    def _scatter(ks: pd.Series, vs: pd.Series) -> pd.Series:
        import numpy as _np
        import pandas as _pd
        out = []
        for k, v in zip(ks, vs):
            row = _np.zeros(n, dtype=_np.float32)
            if k is not None and len(k):
                row[_np.asarray(k, dtype=_np.int64)] = _np.asarray(v, dtype=_np.float32)
            out.append(row)
        return _pd.Series(out)
    return _scatter(keys, values)
