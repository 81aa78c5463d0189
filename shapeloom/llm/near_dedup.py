"""MinHash near-duplicate groups with b-bit signatures.

One pass over the texts makes, per document, the minima of ``HASHES`` hash
functions over its distinct word shingles. Five minima at a time make a band
key; four low bits of every minimum are packed into the signature. Documents
with equal shingle sets are one class from here on. Classes that share a band
key are candidates; the share of equal low bits, corrected for chance, drops
those far below the threshold, and the rest are counted on their full sets.

Band buckets are not expanded into all pairs. First every member is linked to
the best looking of its buckets' minima, which joins most of a group. Only
buckets that still hold several components go on: their members are dealt into
blocks of about ``BLOCK``, and blocks are compared with numpy by a longer
signature, across components only and never within the bucket's largest one.
A pair counts in the first band that it shares. What is still likely is
counted on the full sets, so no link between different components is lost
(beyond the chance of a signature to err, see MARGIN).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as h
from .components import components
from .storage import run_dir, written

#: Fixed parameters of the signature: bands x rows minima, low bits of each.
BANDS, ROWS, BITS = 40, 5, 4
HASHES = BANDS * ROWS
WORDS = -(-HASHES * BITS // 64)
#: A pair goes to the exact count unless its estimate lies this far below the
#: threshold: about five standard errors of HASHES minima.
MARGIN = 0.17
#: The longer signature of bucket members: minima, two low bits of each, and
#: its margin of about 3.7 standard errors.
LONG_HASHES, LONG_BITS, LONG_MARGIN = 1024, 2, 0.06
#: Members of a block, about.
BLOCK = 64

_WORDS = (h.random_words(101, 2 * (HASHES + LONG_HASHES)) >> np.uint64(32)).astype(np.uint32)
XORS, MULTS = _WORDS[::2], _WORDS[1::2] | np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the rows of a chunk, and their row bounds."""
    data = h.LOWER[data]
    starts, ends, bounds = h.word_spans(data, offsets)
    words = h.span_hashes(h.prefix(h.BYTE_WORDS[data]), starts, ends)
    sums = h.prefix(words)
    at, rows = h.window_starts(bounds, width)
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < width))
    begin = np.concatenate([at, bounds[:-1][short]])
    end = np.concatenate([at + width, bounds[1:][short]])
    rows = np.concatenate([rows, short])
    x = h.span_hashes(sums, begin, end)
    pick = np.unique(h.mix(x ^ (rows.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), return_index=True)[1]
    pick = pick[np.argsort(rows[pick], kind="stable")]
    rows, x = rows[pick], x[pick]
    return x, np.searchsorted(rows, np.arange(len(offsets)))


def minima(x: np.ndarray, bounds: np.ndarray, first: int = 0, count: int = HASHES) -> np.ndarray:
    """count x rows minima of non-empty rows."""
    low = (x >> np.uint64(32)).astype(np.uint32)
    out = np.empty((count, len(bounds) - 1), dtype=np.uint32)
    for j in range(count):
        y = low ^ XORS[first + j]
        y *= MULTS[first + j]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        np.minimum.reduceat(y, bounds[:-1], out=out[j])
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """rows x BANDS keys; the band's number is part of the key."""
    out = np.empty((least.shape[1], BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(least.shape[1], b + 1, dtype=np.uint64)
        for j in range(b * ROWS, (b + 1) * ROWS):
            key = h.mix(key * np.uint64(0x9E3779B97F4A7C15) + least[j].astype(np.uint64))
        out[:, b] = key
    return out


def packed(least: np.ndarray, bits: int = BITS) -> np.ndarray:
    """rows x longs of the low ``bits`` of every minimum."""
    per = 64 // bits
    out = np.zeros((-(-len(least) // per), least.shape[1]), dtype=np.uint64)
    for j in range(len(least)):
        out[j // per] |= (least[j] & np.uint32((1 << bits) - 1)).astype(np.uint64) << np.uint64(bits * (j % per))
    return np.ascontiguousarray(out.T)


FEATURES = ("n_shingles bigint, digest array<bigint>, bands array<bigint>, sig array<bigint>")


def features(docs: DataFrame, width: int, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, a hash of the text, the set's size and digest, band keys and signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            for a, b, data, offsets in h.text_chunks(batch.column(2)):
                x, bounds = shingle_sets(data, offsets, width)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                n = b - a
                digest = np.zeros((n, 2), dtype=np.uint64)
                bands, band_bounds = np.zeros((0, BANDS), dtype=np.uint64), np.zeros(n + 1, dtype=np.int64)
                sig = np.zeros((0, WORDS), dtype=np.uint64)
                if len(full):
                    tight = np.append(bounds[full], len(x))
                    least = minima(x, tight)
                    bands, sig = band_keys(least), packed(least)
                    digest[full, 0] = np.add.reduceat(h.mix(x), tight[:-1])
                    digest[full, 1] = np.add.reduceat(h.mix(x ^ np.uint64(0xA0761D6478BD642F)), tight[:-1])
                    band_bounds[1:] = np.cumsum(sizes > 0)
                two = np.arange(n + 1) * 2
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(sizes, type=pa.int64()),
                    h.list_array(h.signed(digest.ravel()), two, pa.int64()),
                    h.list_array(h.signed(bands.ravel()), band_bounds * BANDS, pa.int64()),
                    h.list_array(h.signed(sig.ravel()), band_bounds * WORDS, pa.int64()),
                ], schema=pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()),
                                     ("digest", longs), ("bands", longs), ("sig", longs)]))
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"),
                       F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, " + FEATURES)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles, sketch): the distinct 64-bit shingle hashes of each non-empty row, and its longer signature."""
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in h.text_chunks(batch.column(1)):
                x, bounds = shingle_sets(data, offsets, width)
                sketch = packed(minima(x, bounds, HASHES, LONG_HASHES), LONG_BITS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), h.list_array(h.signed(x), bounds, pa.int64()),
                     h.list_array(h.signed(sketch.ravel()), np.arange(b - a + 1) * sketch.shape[1], pa.int64())],
                    schema=pa.schema([("node", pa.int64()), ("shingles", longs), ("sketch", longs)]))
    return docs.mapInArrow(run, "node bigint, shingles array<bigint>, sketch array<bigint>")


def _members(column) -> tuple[np.ndarray, ...]:
    """node, component, sketch and bands of one block, as arrays."""
    nodes = column.field("node").to_numpy(), column.field("component").to_numpy()
    return *nodes, *(column.field(f).flatten().to_numpy().reshape(len(column), -1) for f in ("sketch", "bands"))


def likely_pairs(blocks: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs across components whose longer signatures come to ``least`` or more.

    ``blocks`` has band, one and other: two lists of members; other is null
    where a block is compared with itself.
    """
    ones = np.uint64(0x5555555555555555)
    chance = 1 / 2 ** LONG_BITS
    most = int((1 - least) * (1 - chance) * LONG_HASHES)  # unlike fields allowed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for k in range(batch.num_rows):
                band = batch.column(0)[k].as_py()
                left = _members(batch.column(1)[k].values)
                alone = not batch.column(2)[k].is_valid
                right = left if alone else _members(batch.column(2)[k].values)
                i, j = np.nonzero(left[1][:, None] != right[1][None, :])
                if alone:
                    i, j = i[i < j], j[i < j]
                for at in range(0, len(i), 4096):
                    p, q = i[at:at + 4096], j[at:at + 4096]
                    d = (left[2][p] ^ right[2][q]).view(np.uint64)
                    unlike = np.bitwise_count((d | (d >> np.uint64(1))) & ones).sum(axis=1, dtype=np.int64)
                    near = np.flatnonzero(unlike <= most)
                    p, q = p[near], q[near]
                    first = np.argmax(left[3][p] == right[3][q], axis=1) == band if len(p) else np.zeros(0, dtype=bool)
                    out_a.append(left[0][p[first]])
                    out_b.append(right[0][q[first]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])
    return blocks.mapInArrow(run, "a bigint, b bigint")


def estimate(a: str, b: str):
    """Collision-corrected similarity of two signatures, by bit counts.

    Fields that differ leave a set bit after folding; equal fields of unlike
    minima happen once in 2**BITS and are taken out.
    """
    ones = F.lit(int("1" * (64 // BITS), 2 ** BITS))

    def differing(x, y):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseAND(ones))
    unlike = F.aggregate(F.zip_with(F.col(a), F.col(b), differing), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / 2 ** BITS
    return (1.0 - unlike / F.lit(float(HASHES)) - chance) / (1.0 - chance)


def near_groups(docs: DataFrame, width: int = 5, percent: int = 75,
                doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate groups of ``docs``.

    Words are maximal runs of bytes other than space, tab and the line breaks,
    A-Z lower-cased; a document's set holds its distinct ``width``-word
    shingles, or its whole word sequence where it has fewer words. Two
    documents are linked if 100 * |intersection| >= percent * |union|.

    Returns doc_id, text_hash, node (the component's own number, null for an
    empty set), n_shingles, component_id (smallest doc_id reachable, itself
    included), kept (doc_id = component_id), one row per input row. Unlike
    texts under one doc_id can share a component_id, but no node. Null or wordless texts have an empty set and link with nothing;
    repeated rows get a row each; rows without doc_id are linked as any other
    but are no component's name: they are not kept where their component has a
    named row, else their component_id is null and kept is true; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "near")
    feats = written(features(docs, width, doc_col, text_col), folder, "features")
    filled = feats.where("n_shingles > 0")
    classes = written(filled.groupBy("digest").agg(F.min("doc_id").alias("rep")), folder, "classes")
    # one row of each class brings its bands and signature; node numbers the class, rep is null if no row has an id
    lead = classes.select(F.col("digest").alias("_digest"), "rep")
    one = filled.join(lead, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    reps = written(one.dropDuplicates(["digest"]).select(
        F.col("doc_id").alias("rep"), F.xxhash64("digest").alias("node"), "text_hash", "bands", "sig"),
        folder, "reps")

    rows = reps.select(F.posexplode("bands").alias("band", "key"), "node")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("pivot")).where("k > 1")
    buckets = written(rows.join(shared, "key"), folder, "buckets")
    nodes = written(buckets.select("node").distinct(), folder, "nodes")
    texts = docs.select(F.xxhash64(text_col).alias("text_hash"), F.col(doc_col).cast("long").alias("rep"),
                        F.col(text_col).cast("string").alias("text"))
    wanted = reps.join(nodes, "node", "left_semi").select(F.col("rep").alias("_rep"), F.col("text_hash").alias("_hash"), "node")
    same = F.col("rep").eqNullSafe(F.col("_rep")) & (F.col("text_hash") == F.col("_hash"))
    involved = texts.join(wanted, same).dropDuplicates(["node"]).select("node", "text")
    sets = written(full_sets(involved, width), folder, "sets")
    sigs = written(reps.join(nodes, "node", "left_semi").select("node", "sig", "bands"), folder, "sigs")

    def estimated(pairs: DataFrame) -> DataFrame:
        left = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
        right = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
        out = pairs.join(left, "a").join(right, "b").withColumn("est", estimate("sig_a", "sig_b"))
        return out.where(F.col("est") >= percent / 100 - MARGIN).select("a", "b", "est")

    def linked(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        # sizes alone rule a pair out before the sets are intersected
        both = pairs.select("a", "b").join(left, "a").join(right, "b")
        small = F.least(F.size("set_a"), F.size("set_b"))
        large = F.greatest(F.size("set_a"), F.size("set_b"))
        both = both.where(small * 100 >= large * percent)
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        return both.where(common * 100 >= union * percent).select("a", "b")

    first = estimated(buckets.where("node != pivot").select(
        F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    best = first.groupBy("b").agg(F.max_by("a", F.struct("est", "a")).alias("a"))
    links = written(linked(best), folder, "links0")
    label = written(components(links), folder, "label")

    marked = buckets.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = marked.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    live = counts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                     F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
    marked = written(marked.join(live, "key"), folder, "live")
    if not marked.isEmpty():
        # 32 bits of a band key tell whether two members share the band
        own = sets.select("node", "sketch").join(sigs.select("node", F.transform(
            "bands", lambda x: F.shiftright(x, 32).cast("int")).alias("bands")), "node")
        many = F.ceil(F.col("k") / BLOCK)
        dealt = marked.join(own, "node").groupBy(
            "key", "band", "k", (F.col("component") == F.col("main")).alias("main"),
            F.when(many > 1, F.pmod(F.xxhash64("node"), many)).otherwise(0).alias("block"))
        dealt = dealt.agg(F.collect_list(F.struct("node", "component", "sketch", "bands")).alias("members"))
        # a bucket of one block is compared in place
        small = marked.where(F.col("k") <= BLOCK).join(own, "node").groupBy("key", "band").agg(
            F.collect_list(F.struct("node", "component", "sketch", "bands")).alias("one"))
        large = written(dealt.where(F.col("k") > BLOCK), folder, "blocks")
        one = large.where("not main").select("key", "band", F.col("block").alias("i"), F.col("members").alias("one"))
        other = large.select("key", "main", F.col("block").alias("j"), F.col("members").alias("other"))
        met = one.join(other, "key").where("main or i <= j")
        met = met.select("band", "one", F.when(F.col("main") | (F.col("i") != F.col("j")), F.col("other")).alias("other"))
        pairs = small.select("band", "one", F.lit(None).cast(large.schema["members"].dataType).alias("other")).unionByName(met)
        more = written(linked(likely_pairs(pairs, percent / 100 - LONG_MARGIN)), folder, "links1")
        if not more.isEmpty():
            label = components(links.union(more))
    named = reps.select("rep", "node").join(label, "node")
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = named.join(smallest, "component").select("node", "component", "component_id")
    result = feats.select("doc_id", "text_hash", "n_shingles", "digest",
                          F.xxhash64("digest").alias("node"))
    result = result.join(of_class, "node", "left").join(classes, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "rep", "doc_id")).otherwise(F.col("doc_id"))
    node = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node"))
    return result.select("doc_id", "text_hash", node.alias("node"), "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))
