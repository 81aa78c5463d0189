"""Line dedup by winnowing over line hashes.

A document is the sequence of its non-blank lines, white space at their ends
aside. Of every ``min_lines`` consecutive line hashes the least (the last of
equals) is a fingerprint, so two equal runs of ``min_lines`` lines select the
same line of the run. Fingerprints that occur more than once are joined to
their positions; each brings its neighbouring line hashes, so the windows of
``min_lines`` lines that reach over it extend the match both ways. Windows are
compared as whole sequences: a line is deleted if a window over it has
occurred at an earlier position, and neighbouring windows make up runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import hashing as h
from .skew import owner_join
from .storage import fresh, run_dir, written

NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[0x0A] = True
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row bounds) of the non-blank lines, trimmed, of a chunk's rows."""
    starts, ends, _ = h.word_spans(data, offsets, NEWLINE)
    solid = np.flatnonzero(~h.SPACE[data])
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    full = last > first
    starts, ends = solid[first[full]], solid[last[full] - 1] + 1
    return h.span_hashes(h.prefix(h.BYTE_WORDS[data]), starts, ends), np.searchsorted(starts, offsets)


def fingerprints(lines: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, rows) of the lines that are the minimum of a window of ``width`` lines."""
    at, rows = h.window_starts(bounds, width)
    if not len(at):
        return at, rows
    place = at.copy()
    for k in range(1, width):
        lower = lines[at + k] <= lines[place]
        place = np.where(lower, at + k, place)
    place, first = np.unique(place, return_index=True)
    return place, rows[first]


def _positions(rows: DataFrame, width: int) -> DataFrame:
    """One row per fingerprint: ids, its hash, line number, and the lines it can share a window with."""
    reach = width - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in h.text_chunks(batch.column(2)):
                lines, bounds = line_hashes(data, offsets)
                at, of = fingerprints(lines, bounds, width)
                if not len(at):
                    continue
                place = at[:, None] + np.arange(-reach, reach + 1)[None, :]
                low, high = bounds[:-1][of][:, None], bounds[1:][of][:, None]
                inside = (place >= low) & (place < high)
                near = lines[np.clip(place, 0, len(lines) - 1)][inside]
                cuts = np.concatenate([[0], np.cumsum(inside.sum(axis=1))])
                own = pa.array(of)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a).take(own), batch.column(1).slice(a, b - a).take(own),
                    pa.array(h.signed(lines[at])),
                    pa.array((np.maximum(place[:, 0], low[:, 0]) - low[:, 0]).astype(np.int32)),
                    h.list_array(h.signed(near), cuts, pa.int64())],
                    names=["doc_id", "text_hash", "line", "first", "near"])
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, line bigint, first int, near array<bigint>")


def _windows(found: DataFrame, width: int, folder: str) -> DataFrame:
    """(window, at): every window of ``width`` lines over a fingerprint that occurs more than once, as a digest, and its place."""
    # copies of one row are one document: they don't repeat each other
    found = found.dropDuplicates(["doc_id", "text_hash", "line", "first"])
    counts = written(found.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), folder, "shared")
    reach = owner_join(found, counts, ["line"], "n").where(F.size("near") >= width)
    windows = reach.select("doc_id", "text_hash", "first", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("near") - (width - 1)),
        lambda i: F.xxhash64(F.slice("near", i, width)))).alias("shift", "window"))
    return windows.select("window", F.struct(
        "doc_id", "text_hash", (F.col("first") + F.col("shift")).alias("start")).alias("at")).distinct()


def repeated_lines(docs: DataFrame, min_lines: int = 1, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, removed: numbers (among non-blank lines) of the lines to delete, for documents that have any."""
    folder = run_dir(docs.sparkSession, "lines")
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = written(_positions(rows, min_lines), folder, "positions")
    if min_lines == 1:  # a window of one line is its own fingerprint
        windows = found.select(F.col("line").alias("window"), F.struct(
            "doc_id", "text_hash", F.col("first").alias("start")).alias("at"))
    else:
        windows = written(_windows(found, min_lines, folder), folder, "windows")
    earliest = windows.groupBy("window").agg(F.min("at").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    earliest = written(earliest, folder, "earliest")
    later = owner_join(windows, earliest, ["window"], "n").where("at > earliest")
    lines = later.select("at.doc_id", "at.text_hash", F.explode(F.sequence(
        F.col("at.start"), F.col("at.start") + (min_lines - 1))).alias("number"))
    return lines.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("number")).alias("removed"))


@F.pandas_udf(StringType())
def _without(texts: pd.Series, removed: pd.Series) -> pd.Series:
    def one(text, numbers):
        if text is None or numbers is None:
            return text
        gone, out, k = set(numbers), [], 0
        for line in text.split("\n"):
            if line.strip(_BLANKS):
                if k not in gone:
                    out.append(line)
                k += 1
            else:
                out.append(line)
        return "\n".join(out)
    return pd.Series([one(t, n) for t, n in zip(texts, removed, strict=True)], dtype=object)


def dedup_lines(docs: DataFrame, min_lines: int = 1, doc_col: str = "doc_id", text_col: str = "text",
                runs: int | None = None) -> DataFrame:
    """``docs`` with ``text_col`` less every later repeated run of ``min_lines`` or more lines.

    By default runs of one line count: every line that stood at an earlier
    position goes, whatever its neighbours. Positions are ordered by doc_id
    (null first), then line; the first occurrence of a run stays, repeats
    within a document go as well. Blank lines are no part of a run and stay.
    Rows equal in id and text are one document and come out alike. Null texts
    stay null, empty ones empty; texts of any length are read whole; an empty
    table gives no rows. All columns stay; one is added: _removed, the number
    of lines deleted (with more underscores in front if the table has that name).

    With ``runs``, at least ``min_lines``, two more are added the same way:
    _run_text, the text less later repeated runs of ``runs`` or more lines
    alone, and _run_removed, how many lines those are.
    """
    if runs is not None and runs < min_lines:
        raise ValueError("runs must not be below min_lines")
    gone_id, gone_hash, numbers, row_id, row_hash, removed, run_numbers, run_text, run_removed = (
        fresh(docs, c) for c in ("_gone_id", "_gone_hash", "_numbers", "_row_id", "_row_hash", "_removed",
                                 "_run_numbers", "_run_text", "_run_removed"))
    gone = repeated_lines(docs, min_lines, doc_col, text_col).select(
        F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash), F.col("removed").alias(numbers))
    if runs is not None:  # a line of a longer run that has occurred is one of a shorter run that has
        longer = repeated_lines(docs, runs, doc_col, text_col).withColumnRenamed("removed", run_numbers)
        gone = gone.join(longer, F.col(gone_id).eqNullSafe(F.col("doc_id")) & (F.col(gone_hash) == F.col("text_hash")),
                         "left").drop("doc_id", "text_hash")
    joined = docs.withColumns({row_id: F.col(doc_col).cast("long"), row_hash: F.xxhash64(text_col)}).join(
        gone, F.col(row_id).eqNullSafe(F.col(gone_id)) & (F.col(row_hash) == F.col(gone_hash)), "left")
    # only texts that lose lines cross to Python
    whole = F.col(text_col).cast("string")
    less = lambda n: F.when(F.col(n).isNull(), whole).otherwise(
        _without(F.when(F.col(n).isNotNull(), whole), F.col(n)))
    out = {text_col: less(numbers), removed: F.greatest(F.size(numbers), F.lit(0))}
    if runs is not None:
        out |= {run_text: less(run_numbers), run_removed: F.greatest(F.size(run_numbers), F.lit(0))}
    return joined.withColumns(out).drop(row_id, row_hash, gone_id, gone_hash, numbers, run_numbers)
