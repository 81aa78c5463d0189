"""models that may fail on single rows, without ending the job."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _objects(values: pd.Series) -> np.ndarray:
    """The values as they are: arrays of one length don't become a matrix."""
    out = np.empty(len(values), dtype=object)
    for k, v in enumerate(values):
        out[k] = v
    return out


def guarded(factory: Callable, return_type: str, batch_size: int = 64) -> Callable[..., Column]:
    """A column function that gives ``struct<value, reason>`` for every row.

    ``factory()`` is called once per task and returns ``predict``, which takes
    one array per column (``batch_size`` rows at most) and returns one value a
    row. If a batch raises, or returns another number of values, it is cut in
    two until the bad rows stand alone: those have a null value and the reason
    ``{exception}: {message}``, all others keep their values. A row whose inputs
    are all null is not handed on and has neither. An array that holds
    non-finite numbers is a bad row.
    """
    @F.pandas_udf(f"struct<value:{return_type},reason:string>")
    def run(columns: pd.Series, *more: pd.Series) -> pd.DataFrame:
        rows = [k for k, row in enumerate(zip(columns, *more)) if any(v is not None for v in row)]
        inputs = [c.iloc[rows].reset_index(drop=True) for c in (columns, *more)]
        values: list = [None] * len(columns)
        reasons: list = [None] * len(columns)
        predict = factory()

        def attempt(low: int, high: int) -> None:
            try:
                found = list(predict(*[_objects(c[low:high]) for c in inputs]))
                if len(found) != high - low:
                    raise ValueError(f"{len(found)} values for {high - low} rows")
            except Exception as e:  # noqa: BLE001  any failure of the model is that row's reason
                if high - low == 1:
                    reasons[rows[low]] = f"{type(e).__name__}: {e}"
                    return
                middle = (low + high) // 2
                attempt(low, middle)
                attempt(middle, high)
                return
            for k, v in enumerate(found, low):
                if isinstance(v, np.ndarray) and v.dtype.kind == "f" and not np.isfinite(v).all():
                    reasons[rows[k]] = "ValueError: non-finite values"
                else:
                    values[rows[k]] = v
        for low in range(0, len(rows), batch_size):
            attempt(low, min(low + batch_size, len(rows)))
        return pd.DataFrame({"value": pd.Series(values, dtype=object), "reason": pd.Series(reasons, dtype=object)})
    return lambda *c: run(*c)
