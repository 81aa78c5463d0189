import itertools
import re

from shapeloom.llm.decontaminate import LEAST, MASKS, MISSES, WINDOW, contaminated

SF = "/root/testdata/sf0.01"


def toks(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """Every aligned window of every document and item that share a token at a diagonal."""
    out = {}
    for i, it in items:
        b = toks(it)
        if len(b) < LEAST:
            continue
        w = min(WINDOW, len(b))
        allowed = MISSES if len(b) >= WINDOW else 1
        for d, text in docs:
            a = toks(text)
            shared = set(a) & set(b)
            if len(shared) < 1:
                continue
            where = {}
            for q, x in enumerate(b):
                where.setdefault(x, []).append(q)
            diagonals = {}
            for p, x in enumerate(a):
                for q in where.get(x, ()):
                    diagonals[p - q] = diagonals.get(p - q, 0) + 1
            spans = []
            for s, n in diagonals.items():
                if n < w - allowed:
                    continue
                lo, hi = max(0, s), min(len(a), s + len(b))
                for p in range(lo, hi - w + 1):
                    miss = sum(a[p + k] != b[p - s + k] for k in range(w))
                    if miss <= allowed:
                        spans.append((p, p + w, miss))
            if spans:
                out[d, i] = (min(x[0] for x in spans), max(x[1] for x in spans), min(x[2] for x in spans))
    return out


def result(df):
    return {(r.doc_id, r.item_id): (r.first_token, r.end_token, r.fewest_unlike) for r in df.collect()}


def test_masks_are_lossless():
    for bad in itertools.combinations(range(WINDOW), MISSES):
        assert any(not {s + o for o in m} & set(bad) for m in MASKS for s in range(WINDOW - m[-1]))


def test_short_items(spark):
    words = [f"w{k}" for k in range(40)]
    items = [(1, "yes"), (2, " ".join(words[:7])), (3, " ".join(words[10:18])), (4, " ".join(words[20:32])), (5, "w18 " * 8)]
    swap = lambda a, b, *at: " ".join("other" if k in at else w for k, w in enumerate(words[a:b]))
    docs = [(1, "yes yes"), (2, " ".join(words)), (3, swap(10, 18, 3)), (4, swap(10, 18, 3, 6)), (5, "x " + swap(20, 32, 11) + " y"),
            (6, swap(20, 32, 0)), (7, swap(20, 32, 0, 11)), (8, " ".join(words[10:17])), (9, " ".join(words[14:18])), (10, "w18 " * 9), (None, None)]
    got = result(contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items)
    assert set(got) == {(2, 3), (2, 4), (3, 3), (5, 4), (6, 4), (10, 5)}


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = result(contaminated(docs, items))
    assert got and got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_substitutions_short_items_nulls_and_extra_columns(spark):
    item = [f"t{i}" for i in range(20)]
    changed = list(item)
    changed[4], changed[11] = "a", "b"
    worse = [x if i % 4 else "z" for i, x in enumerate(item)]
    rows = [(1, "start " + " ".join(item) + " end", 1), (2, "x, y; " + " ".join(changed).upper(), 1), (3, " ".join(worse), 1),
            (4, None, 1), (5, "", 1), (6, "say: Short, item here now", 1), (6, "say: Short, item here now", 1),
            (None, " ".join(item), 2), (7, "q " * 300_000 + " ".join(item[:13]), 1), (8, "short item not here", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, " ".join(item), 0), (2, "short item here", 0), (3, None, 0), (4, "", 0), (4, "!!", 0)],
                                  "item_id long, text string, doc_id int")
    got = result(contaminated(docs, items))
    assert got == brute([(r[0], r[1]) for r in rows], [(1, " ".join(item)), (2, "short item here")])
    assert {k for k in got} == {(1, 1), (2, 1), (None, 1), (7, 1)}  # three tokens prove nothing
    assert contaminated(docs, items.limit(0)).count() == 0 and contaminated(docs.limit(0), items).count() == 0
