import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shapeloom.llm.mixing import Mix, permuted, running_before, unpermuted

SF = "/root/testdata/sf0.01"


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Fill by hand: share by weight, stop at the caps, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def check(docs, **kw):
    rows = docs.select("doc_id", "text", "source").collect()
    size = {(r.doc_id, r.text, r.source): len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    by = Counter()
    for r in rows:
        by[r.source] += size[r.doc_id, r.text, r.source]
    want = brute_targets(by)
    mix = Mix(docs, **kw)
    got = mix.per_document().collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (r.doc_id, r.source, size[r.doc_id, r.text, r.source]) for r in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == by[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():  # half a block, by the source's own size: a tenth of a source of one block or less
        width = max(1, min(mix.block_words, by[s] // 32))
        assert abs(taken[s] - t) <= max(1, width) / 2 + 0.5, (s, by[s], t, taken[s])
        assert by[s] > mix.block_words or by[s] < 5 or abs(taken[s] - t) <= 0.1 * t, (s, by[s], t, taken[s])
    return mix, got


def test_targets_taken_and_reruns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mix, got = check(docs)
    again = Mix(docs.repartition(5)).per_document().collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    slots = mix.slots.collect()
    blocks = {r.number: (r.blocks, r.quota) for r in mix.sources.collect()}
    seen = Counter((r.number, r.block) for r in slots)
    for n, (count, quota) in blocks.items():
        mine = [r for r in slots if r.number == n]
        assert sorted(r.turn for r in mine) == list(range(quota))
        assert all(0 <= r.block < count and seen[n, r.block] <= 2 for r in mine)
        assert quota < count or len({r.block for r in mine if r["pass"] == 0}) == count  # a pass takes every block once


def test_taken_words_by_brute_force(spark):
    """Every slot's block counted word by word, with each document's words at their places."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mix = Mix(docs, block_words=16, shard_slots=64)
    width = {r.number: r.width for r in mix.sources.collect()}
    times = Counter((r.number, r.block) for r in mix.slots.collect())
    rows = mix.rows.collect()
    for n in width:  # the documents lie end to end
        mine = sorted((r.first, r.size) for r in rows if r.number == n and r.size)
        assert all(a + s == b for (a, s), (b, _) in zip(mine, mine[1:])) and (not mine or mine[0][0] == 0)
    want = {(r.doc_id, r.text_hash): sum(times[r.number, w // width[r.number]] for w in range(r.first, r.first + r.size)) for r in rows}
    got = mix.per_document().collect()
    assert {(r.doc_id, r.text_hash): r.taken for r in got} == want and any(want.values())


def test_small_sources_meet_their_targets(spark):
    rows = [(i, "w " * n, f"s{i:02d}") for i, n in enumerate([1, 2, 9, 20, 33, 64, 65, 100, 127, 500, 2049, 3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix, got = check(docs)
    for r in got:
        assert abs(r.taken - r.target) <= max(1, 0.1 * r.target), r
    check(docs.where("source = 's03'"))
    check(docs.where("source in ('s05', 's06')"), block_words=16)


def test_blocks_hold_the_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    mix = Mix(docs, block_words=16, shard_slots=64)
    got = mix.blocks(docs).collect()
    assert len(got) == mix.slots.count()
    assert all(r.n_words == len(r.text.split(" ")) <= 16 for r in got)
    assert sum(r.n_words for r in got) == sum(r.taken for r in mix.per_document().collect())
    counts = Counter()
    for r in {(r.source, r.block): r.text for r in got}.values():
        counts.update(r.split(" "))
    words = Counter(w for r in docs.collect() for w in re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert not counts - words


def test_small_capped_null_and_empty_sources(spark):
    rows = [(1, "a " * 1000, "big"), (2, "b " * 10, "a"), (3, None, "none"), (4, "", None), (5, "c " * 300, None),
            (5, "c " * 300, None), (6, "\t\n", "none"), (6, "\t\n", "none"), (None, "d " * 90, "z"), (7, "é " * 200, "É")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("number", F.lit("x"))
    check(docs, block_words=8, shard_slots=16)
    assert Mix(docs.limit(0)).per_document().count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 97, 1000])
def test_permutation(spark, n):
    got = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))
    back = spark.range(n).select("id", unpermuted(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)), F.lit(n).cast("long"), F.lit(3)).alias("p"))
    assert all(r.id == r.p for r in back.collect())


def test_running_sums_over_stretches(spark):
    rows = spark.range(20_000).selectExpr("id % 2 AS g", "id DIV 2 AS at", "id % 7 AS v").where("at % 3 <> 1")
    got = running_before(rows, ["g"], "at", "v", "before").collect()
    sums = {}
    for r in sorted(got, key=lambda r: (r.g, r["at"])):
        assert r.before == sums.get(r.g, 0)
        sums[r.g] = r.before + r.v
