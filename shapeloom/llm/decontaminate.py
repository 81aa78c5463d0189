"""Benchmark decontamination by spaced-seed hashing.

Both sides are cut into tokens (runs of letters and digits, A-Z lower-cased).
A mask names the offsets whose tokens are hashed and ignores the others; any
stretch of WINDOW aligned tokens with at most MISSES substitutions leaves the
kept offsets of at least one mask untouched (checked in the tests), so equal
hashes find it. Around each hit the neighbouring tokens of both sides are
compared, and a hit counts if a window of WINDOW tokens around it has at most
MISSES unlike ones. Items of LEAST tokens and more that are shorter than a
window must occur whole, with at most one substitution; each half of such an
item is a mask of its own. Shorter items prove nothing by themselves: an answer
of a common word stands in many clean texts.

Documents' hashes are many and the benchmark's few, so a bitmap of fixed size
with the benchmark's hashes goes to every task and drops nearly all of them
before the join. It is the same size for any benchmark: a larger one only lets
more rows through to the join, which decides exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as h
from .storage import run_dir, written

#: Fixed parameters: window length, substitutions allowed in it, kept offsets of the masks.
WINDOW, MISSES = 13, 2
#: Least tokens of an item that can be found.
LEAST = 8
MASKS = ((0, 1, 2, 3, 5, 6, 7), (0, 1, 4, 7, 8, 9, 10), (0, 1, 2, 3, 5, 7, 8))
#: Tokens before and after a hit's first token that a window around it can reach.
REACH = WINDOW - 1
SPAN = 2 * REACH + 1
BITMAP_BITS = 25

_FACTORS = h.random_words(301, 64) | np.uint64(1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = h.LOWER[data]
    starts, ends, bounds = h.word_spans(data, offsets, h.PUNCT)
    return h.span_hashes(h.prefix(h.BYTE_WORDS[data]), starts, ends), bounds


def masked(tok: np.ndarray, bounds: np.ndarray, mask: tuple[int, ...], number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first tokens, rows) of one mask at every place where it fits into a row."""
    at, rows = h.window_starts(bounds, mask[-1] + 1)
    x = np.full(len(at), number + 1, dtype=np.uint64)
    for k, o in enumerate(mask):
        x = x + tok[at + o] * _FACTORS[k]
    return h.mix(x), at, rows


def around(tok: np.ndarray, bounds: np.ndarray, at: np.ndarray, rows: np.ndarray, outside: int) -> np.ndarray:
    """len(at) x SPAN tokens about ``at``, ``outside`` beyond the row's ends."""
    place = at[:, None] + np.arange(-REACH, REACH + 1)[None, :]
    inside = (place >= bounds[:-1][rows][:, None]) & (place < bounds[1:][rows][:, None])
    return np.where(inside, tok[np.clip(place, 0, max(len(tok) - 1, 0))], np.uint64(outside))


_HIT = "mask int, hash bigint, pos int, near array<bigint>"


def _hits(rows: DataFrame, ids: str, masks: list[tuple[int, ...]], lengths: list[int], outside: int, bitmap=None) -> DataFrame:
    """One row per kept masked hash of ``rows`` (two id columns, then text); lengths: of the items of each mask, 0: a window or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in h.text_chunks(batch.column(2)):
                tok, bounds = tokens(data, offsets)
                for number, mask in enumerate(masks):
                    x, at, of = masked(tok, bounds, mask, number)
                    if bitmap is not None:
                        bit = x >> np.uint64(64 - BITMAP_BITS)
                        there = (bitmap.value[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
                        pick = np.flatnonzero(there)
                    elif lengths[number]:  # a short item as a whole
                        pick = np.flatnonzero((np.diff(bounds)[of] == lengths[number]) & (at == bounds[:-1][of]))
                    else:
                        pick = np.flatnonzero(np.diff(bounds)[of] >= WINDOW)
                    x, at, of = x[pick], at[pick], of[pick]
                    if not len(x):
                        continue
                    near = around(tok, bounds, at, of, outside)
                    own = pa.array(of)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(a, b - a).take(own), batch.column(1).slice(a, b - a).take(own),
                        pa.array(np.full(len(x), number, dtype=np.int32)), pa.array(h.signed(x)),
                        pa.array((at - bounds[:-1][of]).astype(np.int32)),
                        h.list_array(h.signed(near.ravel()), np.arange(len(x) + 1) * SPAN, pa.int64())],
                        schema=pa.schema([("id", pa.int64()), ("id2", pa.int64()), ("mask", pa.int32()),
                                          ("hash", pa.int64()), ("pos", pa.int32()), ("near", pa.list_(pa.int64()))]))
    return rows.mapInArrow(run, f"{ids}, {_HIT}")


def _verified(hits: DataFrame) -> DataFrame:
    """Rows of ``hits`` with a good window; adds begin, end (document tokens) and unlike (fewest misses)."""
    schema = "doc_id bigint, text_hash bigint, item_id bigint, item_hash bigint, begin int, end int, unlike int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cols = {f: batch.column(k) for k, f in enumerate(batch.schema.names)}
            length = cols["length"].to_numpy()
            pos = cols["pos"].to_numpy().astype(np.int64)
            left = cols["near"].flatten().to_numpy().reshape(n, SPAN)
            right = cols["item_near"].flatten().to_numpy().reshape(n, SPAN)
            bad = np.zeros((n, SPAN + 1), dtype=np.int64)
            bad[:, 1:] = np.cumsum(left != right, axis=1)
            count = bad[:, WINDOW:] - bad[:, :-WINDOW]  # n x (REACH + 1) windows
            off = np.zeros((n, SPAN + 1), dtype=np.int64)
            off[:, 1:] = np.cumsum((left == 0) | (right == 1), axis=1)
            outside = off[:, WINDOW:] - off[:, :-WINDOW]
            good = (count <= MISSES) & (outside == 0)
            begin = pos - REACH + np.argmax(good, axis=1)
            end = pos - REACH + (count.shape[1] - 1 - np.argmax(good[:, ::-1], axis=1)) + WINDOW
            unlike = np.where(good, count, WINDOW).min(axis=1)
            # a short item: all of it from the hit's first token on
            short, row, last = length > 0, np.arange(n), REACH + length
            misses = bad[row, last] - bad[:, REACH]
            whole = short & (misses <= 1) & (off[row, last] == off[:, REACH])
            begin = np.where(short, pos, begin)
            end = np.where(short, pos + length, end)
            unlike = np.where(short, misses, unlike)
            keep = pa.array(np.flatnonzero(np.where(short, whole, good.any(axis=1))))
            out = [cols[f] for f in ("doc_id", "text_hash", "item_id", "item_hash")]
            out += [pa.array(x.astype(np.int32)) for x in (begin, end, unlike)]
            yield pa.RecordBatch.from_arrays([x.take(keep) for x in out], names=[
                "doc_id", "text_hash", "item_id", "item_hash", "begin", "end", "unlike"])
    return hits.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, first_token, end_token, fewest_unlike: one row per document and item that overlap.

    The tokens [first_token, end_token) span all matching windows. Clean
    documents have no row. Null and wordless texts or items, and items of fewer
    than LEAST tokens, overlap with nothing; texts of any length are read
    whole; repeated rows count once; a null id is kept as null; empty tables
    give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "seeds")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.xxhash64(item_text_col).alias("item_hash"),
                             F.col(item_text_col).cast("string").alias("text"))
    # items shorter than a window: at most WINDOW - 1 lengths, each a mask of its own
    def lengths(batches):
        for batch in batches:
            for _, _, data, offsets in h.text_chunks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(tokens(data, offsets)[1]).astype(np.int32))], names=["n"])
    short = sorted(r.n for r in items.select("text").mapInArrow(lengths, "n int").where(
        f"n >= {LEAST} and n < {WINDOW}").distinct().collect())
    halves = [(tuple(m), n) for n in short for m in (range(n // 2), range(n // 2, n))]
    masks, sizes = [*MASKS, *(m for m, _ in halves)], [0] * len(MASKS) + [n for _, n in halves]
    seeds = written(_hits(items, "item_id bigint, item_hash bigint", masks, sizes, outside=1), folder, "seeds")

    word = F.shiftrightunsigned("hash", 64 - BITMAP_BITS + 6)
    bits = seeds.groupBy(word.alias("word")).agg(F.bit_or(F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP_BITS}) & 63 as int))")).alias("bits"))
    held = bits.toArrow()  # at most 2**(BITMAP_BITS - 6) rows, whatever the benchmark's size
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    bitmap[held.column("word").to_numpy()] = held.column("bits").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(bitmap)

    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))
    found = _hits(rows, "doc_id bigint, text_hash bigint", masks, sizes, outside=0, bitmap=shared)
    sides = found.join(seeds.select("item_id", "item_hash", "mask", "hash", F.col("pos").alias("item_pos"),
                                    F.col("near").alias("item_near")), ["hash", "mask"])
    length = F.element_at(F.lit(np.array(sizes)).cast("array<int>"), F.col("mask") + 1)
    spans = _verified(sides.select("doc_id", "text_hash", "item_id", "item_hash", "pos", "near", "item_near",
                                   length.alias("length")))
    return spans.groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(
        F.min("begin").alias("first_token"), F.max("end").alias("end_token"),
        F.min("unlike").alias("fewest_unlike")).drop("item_hash")
