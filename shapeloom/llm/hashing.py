"""Vectorised tokens and hashes over the Arrow text batches of a task.

A batch is cut into chunks of whole rows of about ``CHUNK_BYTES``, so the
temporary arrays stay small whatever the row count; a single longer text is a
chunk of its own. Hashes are 64-bit: a span's hash comes from prefix sums of
``value * P**i`` (wrapping), shifted back by the inverse power, then mixed.
Equal spans have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
U = np.uint64

#: Bytes of [\x20\x09-\x0D]: what parts words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Everything ASCII that is neither letter nor digit parts plain words.
PUNCT = np.ones(256, dtype=bool)
PUNCT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix): spreads every input bit over the word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(seed))


BYTE_WORDS = random_words(17, 256)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {"p": np.ones(1, dtype=np.uint64), "i": np.ones(1, dtype=np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n, kept per worker up to a few chunks."""
    have = len(_powers["p"])
    if have >= n:
        return _powers["p"][:n], _powers["i"][:n]
    size = max(n, 4 * CHUNK_BYTES)
    inverse = pow(_BASE, -1, 1 << 64)

    def table(base: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    p, i = table(_BASE), table(inverse)
    if size <= 8 * CHUNK_BYTES:
        _powers["p"], _powers["i"] = p, i
    return p[:n], i[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * P**i`` with a leading zero."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of each span [start, end), from ``prefix`` sums."""
    inverse = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets of len rows + 1); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, raw[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row bounds): words of every row; row r has words bounds[r]:bounds[r + 1]."""
    inside = ~parts[data]
    n = len(data)
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    cuts = offsets[:-1][offsets[:-1] < n]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def window_starts(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, row of each): windows of ``width`` items that stay inside one row."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - first[rows] + bounds[:-1][rows], rows


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return x.view(np.int64)


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column: row r holds values[bounds[r]:bounds[r + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))
