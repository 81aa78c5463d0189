"""Joins whose left side may hold one key in a large share of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than 1/SHARE of the rows is hot; there are at most SHARE of them.
SHARE = 1024


def owner_join(left: DataFrame, owners: DataFrame, keys: list[str], rows: str, how: str = "inner") -> DataFrame:
    """``left`` joined to ``owners``, which has one row per key and, in ``rows``, how many rows of left the key has.

    The owners of hot keys, at most SHARE rows whatever the input, are
    broadcast, so their rows stay where they are; all others are shuffled.
    ``left`` is read twice. Keys are not null. ``rows`` is dropped.
    """
    total = owners.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    is_hot = F.col(rows) * SHARE > F.lit(total)
    hot, rest = F.broadcast(owners.where(is_hot).drop(rows)), owners.where(~is_hot).drop(rows)
    spread = left.join(hot, keys, "inner")
    return spread.unionByName(left.join(F.broadcast(owners.where(is_hot).select(*keys)), keys, "left_anti").join(rest, keys, how))
