import re

import pytest

from shapeloom.llm.components import components
from shapeloom.llm.near_dedup import near_groups

SF = "/root/testdata/sf0.01"


def shingles(text, width=5):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, percent=75):
    """Components by counting the common shingles of every pair that has one."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    common = {}
    for ids in where.values():
        for k, i in enumerate(ids):
            for j in ids[k + 1:]:
                common[i, j] = common.get((i, j), 0) + 1
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            parent[find(i)] = find(j)
    out = {}
    for i, (d, _) in enumerate(rows):
        out.setdefault(find(i), []).append(d)
    return {d: (len(sets[i]), min(out[find(i)])) for i, (d, _) in enumerate(rows)}


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = near_groups(docs).collect()
    assert len(got) == len(want)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chains_and_many_unlike_members_of_a_bucket(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):  # each differs from the next in one word near its own place
        words = list(base)
        for k in range(i % 20):
            words[3 * k] = f"x{k}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for d, (_, c) in brute(rows).items()}


def test_nulls_empties_ties_and_extra_columns(spark):
    rows = [(1, None, 5, "a"), (2, "", 5, "b"), (3, " \t\n", 5, None), (4, "One two", 1, "c"), (4, "One two", 1, "c"),
            (5, "one TWO", 2, "d"), (6, "É two", 2, "d"), (7, "é two", 2, "d"), (None, "lone words here", 3, "e"),
            (8, "x " * 200_000, 1, "f"), (9, "X x x x x x", 1, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep int, node string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_groups(docs).collect()), key=repr)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True),
                          (5, 1, 4, False), (6, 1, 6, True), (7, 1, 7, True), (None, 1, None, True),
                          (8, 1, 8, True), (9, 1, 8, False)], key=repr)
    assert near_groups(docs.limit(0)).count() == 0


def test_rows_without_id_are_linked(spark):
    def text(w, *more):
        return " ".join([*(f"{w}{i}" for i in range(60)), *more])
    rows = [(1, text("a")), (None, text("a")), (None, text("a", "near")), (2, text("b")), (None, text("c")), (None, text("c", "near")),
            (None, text("d", "x", "y")), (5, text("d", "x", "y", "z", "v")), (4, text("d"))]
    got = [(r.doc_id, r.component_id, r.kept) for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=repr) == sorted([(1, 1, True), (None, 1, False), (None, 1, False), (2, 2, True), (None, None, True),
                                            (None, None, True), (None, 4, False), (5, 4, False), (4, 4, True)], key=repr)


@pytest.mark.parametrize("n", [2, 30])
def test_components_of_a_path(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 100), (200, 201)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {200: 200, 201: 200}
