"""Query registry: name -> Spark builder + equivalent DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    operators: str


QUERIES: dict[str, Query] = {}


def query(name: str, operators: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle, operators)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan.

    Bench and test sessions spread single-row-group files over their cores
    (see ``spread``).
    """
    from ..session import spread
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def load_all() -> dict[str, Query]:
    """Import every query module so that its queries register."""
    from . import q_features, q_meshes, q_text, q_training, q_voxels, q_warehouse  # noqa: F401
    return QUERIES
