import hashlib
import random

import numpy as np

from shapeloom.llm.fingerprint import (GEAR, GREATEST, LEAST, LOOSE_BITS, NORMAL, STRICT_BITS, chunk_weights, containment, cuts,
                                       fingerprint_edits, gear, written_form)


def slow_cuts(data):
    """Byte by byte, as the definition says."""
    ends, at, x = [], 0, []
    for i in range(len(data)):
        x.append(sum(int(GEAR[data[i - j]]) << j for j in range(min(32, i + 1))) & 0xFFFFFFFF)
    for i in range(len(data)):
        n = i + 1 - at
        if n < LEAST:
            continue
        bits = STRICT_BITS if n < NORMAL else LOOSE_BITS
        if x[i] >> (32 - bits) == 0 or n == GREATEST:
            ends.append(i + 1)
            at = i + 1
    return ends + [len(data)] if at < len(data) else ends


def test_cuts_equal_the_definition():
    rng = random.Random(3)
    for n in (0, 1, 31, 32, 33, 200, 5000):
        data = np.array([rng.randrange(97, 105) for _ in range(n)], dtype=np.uint8)
        got = list(cuts(data))
        want = slow_cuts(data.tolist())
        # a tail of at most LEAST bytes is not cut again
        assert got == want, n
    assert (np.diff([0, *cuts(np.zeros(5000, dtype=np.uint8))])[:-1] <= GREATEST).all()
    assert gear(np.array([7], dtype=np.uint8))[0] == GEAR[7]


def test_shift_resistance_and_containment():
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(40_000)).encode()
    a, b, c = chunk_weights(text), chunk_weights(b"inserted " + text), chunk_weights(text[:20_000])
    assert containment(a, a) == 1 and containment(a, b) > 0.97 and abs(containment(a, c) - 0.5) < 0.03 and containment(c, a) > 0.97
    assert containment({}, {}) == 1 and containment(a, {}) == 0 == containment({}, a)


def brute(rows):
    ordered = sorted([(d, t or "") for d, t in rows], key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (d, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        w, e, n = (chunk_weights(x.encode()) for x in (t, edited, nxt))
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), written_form(w), written_form(e), containment(w, e), containment(w, n)))
    return sorted(out, key=repr)


def shown(df):
    return sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
                   for r in df.collect()], key=repr)


def test_equals_brute_force_over_many_ranges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert shown(fingerprint_edits(docs.repartition(7), range_bytes=100_000)) == want
    assert shown(fingerprint_edits(docs)) == want


def test_nulls_empties_repeats_and_extra_columns(spark):
    rows = [(2 ** 60, None), (2 ** 60 + 1, ""), (2 ** 60 + 2, "é" * 7), (None, "first"), (2 ** 60 + 3, "same text " * 40),
            (2 ** 60 + 3, "same text " * 40), (2 ** 60 + 4, "long " * 200_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, range int")
    assert shown(fingerprint_edits(docs, range_bytes=300)) == brute(rows)
    assert shown(fingerprint_edits(docs.where("doc_id is null"))) == brute([(None, "first")])
    assert fingerprint_edits(docs.limit(0)).count() == 0


def test_ranges_are_cut_at_the_same_rows(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from shapeloom.llm.ranges import ranges_of
    from shapeloom.llm.storage import run_dir
    rng = random.Random(9)
    rows = [(rng.choice([None, 1, rng.randrange(-50, 50)]), rng.randrange(-9, 9), rng.randrange(0, 40)) for _ in range(3000)]
    groups = {}
    for i, d, n in rows:
        groups[-2 ** 63 if i is None else i, d] = groups.get((-2 ** 63 if i is None else i, d), 0) + n
    want, begin, ranges = {}, 0, []
    for key in sorted(groups):
        if not ranges or begin // 500 != ranges[-1]:
            ranges.append(begin // 500)
        want[key] = len(ranges) - 1
        begin += groups[key]
    df = spark.createDataFrame(rows, "id long, digest long, size long")
    for parts in (1, 9):
        found = ranges_of(df.repartition(parts), 500, run_dir(spark, "ranges-test"))
        got = df.select("id", "digest", found.of(F.col("id"), F.col("digest")).alias("p")).collect()
        assert {(-2 ** 63 if r.id is None else r.id, r.digest): r.p.range for r in got} == want and found.count == len(ranges)
        assert len({(r.id, r.digest) for r in got if r.p.first}) == len(ranges)
    assert isinstance(found._held.value[0], np.ndarray)


def test_many_ranges_are_planned_quickly(spark):
    import time
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat(cast(id AS string), 10) AS text")
    began = time.time()
    plan = fingerprint_edits(docs, range_bytes=2)
    assert time.time() - began < 30 and len(plan._jdf.queryExecution().toString()) < 50_000
