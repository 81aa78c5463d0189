"""Incremental description cleaning on a streaming source.

The original builder is batch only; nothing here adds new semantics. The text
rules (T01-T04) are stateless Columns, so the same builders run unchanged on a
``readStream`` frame. Keep-first per uid (W01) needs state: in a stream it is
``dropDuplicatesWithinWatermark`` over an event-time column, which keeps the
first arrival of each uid within the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def clean_descriptions(stream: DataFrame, event_time: str | None = None, watermark: str = "1 hour",
                       key: str = "uid") -> DataFrame:
    """``(uid, category, description_raw)`` stream -> cleaned, non-empty, first per uid."""
    out = stream.withColumn("description", tx.clean_description("description_raw"))
    out = out.where(F.length("description") > 0)
    if event_time is None:
        return out
    return out.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([key])
