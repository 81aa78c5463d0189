"""Ranges of about equal bytes over an order of rows; they depend on the rows alone.

Rows are ordered by two longs (an id and a digest). The first row of each
range is found from exact running sums, whatever order or partitions the rows
come in, so two runs cut at the same places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

#: Stands for a missing id: before all others.
NO_ID = -(1 << 63)


class Ranges:
    """The first (id, digest) of each range, in order: 16 bytes for each ``target`` bytes of rows."""

    def __init__(self, spark, ids: np.ndarray, digests: np.ndarray):
        self.count = max(1, len(ids))
        self._held = spark.sparkContext.broadcast((ids, digests))

    def of(self, row_id: Column, digest: Column) -> Column:
        """struct(range, first): the row's range, and whether it is that range's first."""
        held = self._held

        @F.pandas_udf("range int, first boolean")
        def place(row_ids: pd.Series, row_digests: pd.Series) -> pd.DataFrame:
            ids, digests = held.value
            i, d = row_ids.to_numpy(np.int64), row_digests.to_numpy(np.int64)
            low, high = np.searchsorted(ids, i, side="left"), np.searchsorted(ids, i, side="right")
            at = high.copy()
            for k in np.flatnonzero(low < high):  # an id at which a range begins
                at[k] = low[k] + np.searchsorted(digests[low[k]:high[k]], d[k], side="right")
            at = np.maximum(at - 1, 0)
            first = (ids[at] == i) & (digests[at] == d) if len(ids) else np.zeros(len(i), dtype=bool)
            return pd.DataFrame({"range": at.astype(np.int32), "first": first})
        return place(F.coalesce(row_id, F.lit(NO_ID)), digest)


def ranges_of(sizes: DataFrame, target: int, folder: str) -> Ranges:
    """Cut rows (id, digest, size) into ranges of about ``target`` bytes by id (null first), then digest.

    A range begins at the first row past each multiple of ``target``, so a
    larger row has a range of its own; rows equal in id and digest stay together.
    """
    whole = sizes.select(F.coalesce("id", F.lit(NO_ID)).alias("id"), "digest", "size").groupBy("id", "digest").agg(
        F.sum("size").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sums = np.cumsum(batch.column(2).to_numpy()) + before
            before = int(sums[-1]) if len(sums) else before
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sums), task), pa.int32()), batch.column(0), batch.column(1),
                 pa.array(sums - batch.column(2).to_numpy()), pa.array(sums)], names=["task", "id", "digest", "begin", "end"])
    sums = whole.repartitionByRange("id", "digest").sortWithinPartitions("id", "digest").mapInArrow(
        run, "task int, id bigint, digest bigint, begin bigint, end bigint")
    sums = written(sums, folder, "running")
    tasks = sums.groupBy("task").agg(F.max("end").alias("all"))  # a row per shuffle partition
    tasks = tasks.withColumn("before", F.sum("all").over(Window.orderBy("task")) - F.col("all")).drop("all")
    placed = sums.join(F.broadcast(tasks), "task").withColumn("range", F.floor((F.col("before") + F.col("begin")) / F.lit(target)))
    firsts = placed.groupBy("range").agg(F.min(F.struct("id", "digest")).alias("first"))
    rows = firsts.orderBy("range").select("first.id", "first.digest").toArrow()
    return Ranges(sizes.sparkSession, rows.column("id").to_numpy(), rows.column("digest").to_numpy())
