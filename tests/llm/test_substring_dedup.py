import random
import re

import pytest

from shapeloom.llm.substring_dedup import COVER, PERIOD, remove_repeats


def brute(rows, w=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (d, _), s in zip(rows, words):
        if d is not None:
            for i in range(len(s) - w + 1):
                k = tuple(s[i:i + w])
                least[k] = min(least.get(k, d), d)
    out = []
    for (d, _), s in zip(rows, words):
        gone = set()
        for i in range(len(s) - w + 1):
            if d is not None and least[tuple(s[i:i + w])] < d:
                gone |= set(range(i, i + w))
        out.append((d, len(s), len(gone), " ".join(x for k, x in enumerate(s) if k not in gone)))
    return sorted(out, key=repr)


def shown(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()], key=repr)


def test_cover():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = shown(remove_repeats(docs))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] > 0 for r in got) > 50


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_at_any_offset(spark, seed):
    rng = random.Random(seed)
    text = [f"w{i}" for i in range(400)]
    rows = []
    for d in range(60):
        a = rng.randrange(300)
        n = rng.choice([49, 50, 51, 60, 100])
        rows.append((rng.randrange(50), " ".join([f"x{d}_{i}" for i in range(rng.randrange(70))] + text[a:a + n]
                                                 + [f"y{d}_{i}" for i in range(rng.randrange(70))])))
    assert shown(remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_nulls_empties_repeats_and_extra_columns(spark):
    p = " ".join(f"p{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, p), (4, p), (5, "a " + p + "\n\nb"), (6, p.upper()), (None, p), (None, p + " c"),
            (7, "z " * 300_000), (8, "z " * 60), (9, "one two"), (10, "one two"), (5, "other"), (11, p)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, hash int, n_words int")
    assert shown(remove_repeats(docs)) == brute(rows)
    assert remove_repeats(docs.limit(0)).count() == 0
