"""Main text of pages by the recurrent block labeller."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import blocks
from .html_model import Sequence, probabilities, trained

RESULT = "page_id bigint, url string, text string, n_chars bigint"
#: Pages whose blocks are labelled together.
GROUP = 256


def main_text(pages: list[str], weights: list, least: float = 0.5) -> list[str]:
    """Main text of each page: its blocks of probability ``least`` or more, joined by line breaks."""
    parsed = [blocks(p) for p in pages]
    found = probabilities(weights, [Sequence(p) for p in parsed])
    return ["\n".join(b.text for b, p in zip(page, prob, strict=True) if p >= least) for page, prob in zip(parsed, found, strict=True)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points); a row per input row.

    The whole html is read, character references are decoded, white space
    inside a block becomes one space, and the blocks of the main text are
    joined in page order by one line break. A page without html or without
    main text has an empty text; a page of any length takes time in proportion
    and is read a window of blocks at a time; repeated rows come out alike; an empty table
    gives no rows; other columns are not read.
    """
    held = pages.sparkSession.sparkContext.broadcast([w.copy() for w in trained()])
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                texts = main_text([x or "" for x in part.column(2).to_pylist()], held.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.string()), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], schema=schema)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, RESULT)
