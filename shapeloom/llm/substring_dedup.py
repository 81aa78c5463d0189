"""Substring dedup with difference-cover anchors.

Places of a document are taken modulo PERIOD, and only those in COVER, a
difference cover, are anchors: whatever two places a match of WINDOW words
starts at, within PERIOD - 1 words both sides stand on a cover place at once
and the ANCHOR words from there lie inside the match. So equal windows share
an aligned anchor, and anchors need only a sixth of all places. Anchors that
occur in more than one document are extended to the windows around them;
those windows are compared as whole sequences (64-bit hashes of all their
words), and a word goes if a window over it also starts in a document with a
smaller doc_id.

A document whose whole word sequence a smaller doc_id has too is settled by
its digest: it brings no anchors. The texts are dealt out by doc_id once;
the later passes read the same exchange, so everything up to the result is one
plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as h
from .storage import run_dir, written

#: A perfect difference set: every difference modulo 31 is one of two members'.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
WINDOW = 50

_SALT = np.uint64(0xD6E8FEB86659FD93)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, bounds = h.word_spans(data, offsets)
    return h.span_hashes(h.prefix(h.BYTE_WORDS[data]), starts, ends), bounds


def _per_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that also differ by row."""
    return h.mix(hashes ^ (rows.astype(np.uint64) * _SALT))


def _distinct(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pick = np.unique(_per_row(hashes, rows), return_index=True)[1]
    return hashes[pick], rows[pick]


def anchors(words: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, places, rows) of the anchors of rows of at least ``window`` words."""
    width = window - PERIOD + 1
    at, rows = h.window_starts(bounds, width)
    on = np.isin((at - bounds[:-1][rows]) % PERIOD, COVER) & (np.diff(bounds)[rows] >= window)
    at, rows = at[on], rows[on]
    return h.span_hashes(h.prefix(words), at, at + width), at, rows


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each; null rows have none."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(np.arange(len(column)), sizes)


def _digests(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in h.text_chunks(batch.column(1)):
                words, bounds = _words(data, offsets)
                one = h.span_hashes(h.prefix(words), bounds[:-1], bounds[1:])
                two = h.span_hashes(h.prefix(h.mix(words ^ _SALT)), bounds[:-1], bounds[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(h.signed(one)), pa.array(h.signed(two)),
                     pa.array(np.diff(bounds))], names=["doc_id", "d1", "d2", "n_words"])
    return docs.mapInArrow(run, "doc_id bigint, d1 bigint, d2 bigint, n_words bigint")


def _anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(2).is_null())  # not a copy
            for a, b, data, offsets in h.text_chunks(batch.column(1)):
                x, _, rows = anchors(*_words(data, offsets), window)
                x, rows = _distinct(x, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.signed(x)), batch.column(0).slice(a, b - a).take(pa.array(rows))], names=["hash", "doc_id"])
    return docs.mapInArrow(run, "hash bigint, doc_id bigint")


def _window_rows(docs: DataFrame, window: int) -> DataFrame:
    """The windows that reach over a shared anchor (third column: the document's)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            for a, b, data, offsets in h.text_chunks(batch.column(1)):
                words, bounds = _words(data, offsets)
                x, at, rows = anchors(words, bounds, window)
                shared, of = _lists(batch.column(2).slice(a, b - a))
                hit = np.isin(_per_row(x, rows), _per_row(shared, of))
                at, rows = at[hit], rows[hit]
                # an anchor lies in the windows that start up to PERIOD - 1 words before it
                step = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(step, np.maximum(at - (PERIOD - 1), bounds[:-1][rows]), 1)
                np.add.at(step, np.minimum(at, bounds[1:][rows] - window) + 1, -1)
                starts = np.flatnonzero(np.cumsum(step)[:-1] > 0)
                row = np.searchsorted(bounds, starts, side="right") - 1
                y, row = _distinct(h.span_hashes(h.prefix(words), starts, starts + window), row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.signed(y)), batch.column(0).slice(a, b - a).take(pa.array(row))], names=["hash", "doc_id"])
    return docs.mapInArrow(run, "hash bigint, doc_id bigint")


def _kept_rows(docs: DataFrame, window: int) -> DataFrame:
    """Columns doc_id, text, repeated windows (or null), copy (or null) to the result."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in h.text_chunks(batch.column(1)):
                part = batch.slice(a, b - a)
                copy = part.column(3).fill_null(False).to_numpy(zero_copy_only=False)
                gone, of = _lists(part.column(2))
                cover = bounds = None
                if len(gone):
                    words, bounds = _words(data, offsets)
                    at, rows = h.window_starts(bounds, window)
                    x = h.span_hashes(h.prefix(words), at, at + window)
                    at = at[np.isin(_per_row(x, rows), _per_row(gone, of))]
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    step[at] += 1
                    step[at + window] -= 1
                    cover = np.cumsum(step)[:-1] > 0
                touched = np.zeros(b - a, dtype=bool)
                touched[of] = True
                raw, n_words, n_removed, kept = data.tobytes(), [], [], []
                for r in range(b - a):
                    words_of = raw[offsets[r]:offsets[r + 1]].split()  # bytes.split parts at [\x20\x09-\x0D] runs
                    n = len(words_of)
                    if copy[r] and n >= window:
                        words_of = []
                    elif touched[r]:
                        out = cover[bounds[r]:bounds[r + 1]]
                        words_of = [w for w, o in zip(words_of, out.tolist(), strict=True) if not o]
                    n_words.append(n)
                    n_removed.append(n - len(words_of))
                    kept.append(b" ".join(words_of).decode())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                                  pa.array(kept, pa.string())], schema=schema)
    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def _shared(rows: DataFrame, keep) -> DataFrame:
    """(doc_id, hashes): a row's hashes that ``keep`` picks by their group's sums.

    A hash's group is summed before the shuffle and joined back, which Spark
    can split; the list of a document is no longer than the document.
    """
    sums = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")).where("n > 1")
    return rows.join(sums, "hash").where(keep).groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space); a row per input row.

    Words are maximal runs of bytes other than space, tab and the line breaks,
    unchanged. Every word covered by a window of ``window`` consecutive words
    whose sequence also starts in a document with a smaller doc_id goes;
    windows are judged on the input. Rows that share a doc_id don't remove
    from each other; a null doc_id is neither smaller nor larger than any. A
    null text has no words and an empty ``kept``; an empty table gives no rows;
    other columns are not read. ``window`` must exceed PERIOD.
    """
    if window <= PERIOD:
        raise ValueError(f"window must exceed {PERIOD}")
    folder = run_dir(docs.sparkSession, "repeats")
    texts = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = written(_digests(texts), folder, "digests")
    first = seen.groupBy("d1", "d2", "n_words").agg(F.min("doc_id").alias("least"))
    copies = seen.join(first, ["d1", "d2", "n_words"]).groupBy("doc_id").agg(
        F.min(F.col("doc_id") > F.col("least")).alias("copy")).where("copy")
    copies = written(copies, folder, "copies")
    # left joins throughout, and the choice of rows inside the tasks: the text
    # side of every join is then the same exchange, which Spark reuses
    own = _anchor_rows(texts.join(copies, "doc_id", "left").select("doc_id", "text", "copy"), window)
    near = _window_rows(texts.join(_shared(own, F.lit(True)), "doc_id", "left").select("doc_id", "text", "hashes"), window)
    repeated = _shared(near, F.col("doc_id") > F.col("least"))
    full = texts.join(repeated, "doc_id", "left").join(copies, "doc_id", "left")
    return _kept_rows(full.select("doc_id", "text", "hashes", "copy"), window)
