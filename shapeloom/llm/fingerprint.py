"""Document fingerprints by content-defined chunking.

A gear hash (each byte's random word, doubled at every step, so 32 bytes
count) names the places where a text may be cut. Chunk sizes are normalised:
up to the normal size few places count, after it many, and none before the
least or after the greatest size. As cuts depend on nearby bytes only, an edit
changes the chunks around it and no others. The fingerprint is the set of the
chunks' digests with their bytes; the share of one fingerprint's bytes that
the other has too measures containment.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as h
from .ranges import ranges_of
from .storage import run_dir

#: Fixed parameters: bytes of a chunk, and hash bits that must be zero up to and after the normal size.
LEAST, NORMAL, GREATEST = 32, 128, 512
STRICT_BITS, LOOSE_BITS = 9, 5

GEAR = (h.random_words(401, 256) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """32-bit gear hash at every byte: sum of GEAR[byte] << distance, by doubling."""
    x = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        y = x.copy()
        y[k:] += x[:-k] << np.uint32(k)
        x = y
    return x


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's bytes, the last one included."""
    n = len(data)
    if n <= LEAST:
        return np.array([n] if n else [], dtype=np.int64)
    x = gear(data)
    loose = np.flatnonzero((x >> np.uint32(32 - LOOSE_BITS)) == 0)
    strict = (loose[(x[loose] >> np.uint32(32 - STRICT_BITS)) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    ends, at, n_strict, n_loose = [], 0, len(strict), len(loose)
    while n - at > LEAST:
        end = min(at + GREATEST, n)
        k = bisect_left(strict, at + LEAST)
        if k < n_strict and strict[k] < at + NORMAL and strict[k] <= end:
            end = strict[k]
        else:
            k = bisect_left(loose, at + NORMAL)
            if k < n_loose and loose[k] < end:
                end = loose[k]
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return np.array(ends, dtype=np.int64)


def chunk_weights(text: bytes) -> dict[int, int]:
    """Digest of each distinct chunk, with the bytes of all its occurrences."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = cuts(data)
    if not len(ends):
        return {}
    starts = np.concatenate([[0], ends[:-1]])
    digests = h.span_hashes(h.prefix(h.BYTE_WORDS[data]), starts, ends)
    out: dict[int, int] = {}
    for d, n in zip(digests.tolist(), (ends - starts).tolist(), strict=True):
        out[d] = out.get(d, 0) + n
    return out


def written_form(weights: dict[int, int]) -> str:
    """``digest:bytes`` in order of digest, parted by spaces."""
    return " ".join(f"{d:016x}:{n}" for d, n in sorted(weights.items()))


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """Share of ``own``'s bytes whose chunks ``other`` has; of two empty texts 1, of one 0."""
    if not own or not other:
        return float(not own and not other)
    if len(other) < len(own):
        shared = sum(min(n, own.get(d, 0)) for d, n in other.items())
    else:
        shared = sum(min(n, other.get(d, 0)) for d, n in own.items())
    return shared / sum(own.values())


RESULT = ("doc_id bigint, text_hash bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
_RESULT = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def fingerprint_edits(docs: DataFrame, range_bytes: int = 16 << 20, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; a row per input row.

    The edited text has its last floor(n_chars / 2) code points replaced by
    the first as many (or all) of the next document, by doc_id and after the
    last the first. near_* is the containment of the document's fingerprint in
    the edited text's and in the next document's.

    Documents are dealt out once, by ranges of about ``range_bytes`` in the
    order of doc_id, a task for each; each range's first document goes to the
    range before as well, so a task has every next text and holds two
    documents at a time.

    A null text is empty; rows without doc_id come first; rows that share a
    doc_id are ordered by text hash, and equal rows follow one another; a
    document alone is its own next; an empty table gives no rows; other
    columns are not read.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "chunks")
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    ranges = ranges_of(rows.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("digest"),
                                   F.octet_length("text").cast("long").alias("size")), range_bytes, folder)
    placed = rows.withColumn("place", ranges.of(F.col("doc_id"), F.col("text_hash")))
    ranged = placed.select("doc_id", "text_hash", "text", "place.range", F.lit(0).alias("guest"))
    # the first document of a range also ends the range before, that of the first range the last
    before = F.when(F.col("place.range") == 0, F.lit(ranges.count - 1)).otherwise(F.col("place.range") - 1)
    guests = placed.where("place.first").select("doc_id", "text_hash", "text", before.alias("range"), F.lit(1).alias("guest"))
    both = ranged.unionByName(guests.dropDuplicates(["doc_id", "text_hash"]))
    both = both.repartitionById(ranges.count, "range").sortWithinPartitions("range", "guest", "doc_id", "text_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, out, size = None, [], 0  # last: id, hash, text, weights of the document whose next is awaited
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ranges, guests = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for k in range(batch.num_rows):
                text = batch.column(2)[k].as_py()
                if last is not None and last[1] == hashes[k] and last[2] == text:
                    weights = last[3]
                else:
                    weights = chunk_weights(text.encode())
                if last is not None:
                    own = last[2]
                    half = len(own) // 2
                    edited = (own[:len(own) - half] + text[:half]).encode()
                    edited_weights = chunk_weights(edited)
                    row = (last[0], last[1], len(own), hashlib.sha256(edited).hexdigest(), written_form(last[3]),
                           written_form(edited_weights), containment(last[3], edited_weights), containment(last[3], weights))
                    out.append(row)
                    size += len(row[4]) + len(row[5])
                    if size > 4 << 20:
                        yield _batch(out)
                        out, size = [], 0
                last = None if guests[k] else (ids[k], hashes[k], text, weights)
                assert ranges[k] is not None
        yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(_RESULT)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)], schema=_RESULT)
    return both.mapInArrow(run, RESULT)
