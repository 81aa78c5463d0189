"""shapeloom: a Spark-first engine for building and checking text-and-shape datasets.

Every public operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function over explicit schemas, so Catalyst plans the work end to end.
"""

__version__ = "0.1.0"

try:  # ship this package's functions by value, so executors need no install
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
