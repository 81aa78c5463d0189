"""The trie of rebuilt conversations against a plain trie in Python, and its monoid against integers."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import pytest

from shapeloom.llm import prefix_trie, queries
from shapeloom.llm.prefix_trie import PRIME, power, times, trie

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns, key=lambda t: t[0])] for c, turns in convs.items()}
    members = defaultdict(list)
    rebuilt = {}
    for c in own:
        h = crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    out = []
    for key, cs in members.items():
        below = [k for k in members if k[:len(key)] == key]
        leaf = {k for k in members if not any(len(o) == len(k) + 1 and o[:-1] == k for o in members)}
        out.append((min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs),
                    sum(len(k) == len(key) + 1 for k in below), sum(k in leaf for k in below),
                    sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k),
                    sha256(",".join(str(c) for c in sorted(cs) if rebuilt[c] == key).encode()).hexdigest()))
    return out


def check(spark, rows, **made):
    got = trie(spark.createDataFrame(rows, SCHEMA), **made).select(*NAMES).collect()
    key = lambda r: (r[1], r[0], repr(r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(rows), key=key)


def test_query_equals_sql_on_every_row(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    res = con.execute(queries.OP11_SQL)
    order = [[d[0] for d in res.description].index(n) for n in NAMES]
    want = sorted(tuple(r[i] for i in order) for r in [[-1 if v is None else v for v in r] for r in res.fetchall()])
    got = queries.QUERIES["op11_prefix_trie"].build(spark, SF).select(*NAMES).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == want and len(want) > 200


def rows_of(seed, n_convs=40):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-9, 90), n_convs):
        for t in range(rng.choice([1, 2, 3, 9, 10, 14])):
            same = rng.random() < 0.7
            rows.append((c, t, "ab"[t % 2], f"t{t}" if same else f"{c}é{t}"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations_equal_a_plain_trie(spark, seed):
    check(spark, rows_of(seed))


def test_ties_nulls_copies_and_absent_bases(spark):
    rows = [(5, None, None, None), (5, 0, "u", None), (5, 0, "u", "x"), (5, 0, "u", "x"), (5, 0, "a", "z"),
            (None, 0, "u", "no conversation"), (None, None, None, None), (6, 0, "u", "only"), (7, 3, "u", "x"), (7, -1, "", ""),
            (21, 0, "u", "no base"), (22, 0, "u", "no base"), (1000003, 1, "u", "x" * 300_000), (1000004, 1, "u", "x" * 300_000)]
    rows += [(c, t, "u", "same") for c in range(40, 60, 5) for t in range(3)]
    check(spark, rows)


def test_one_conversation_holds_most_rows(spark):
    """Its turns stand in many tasks, so that running products are carried from task to task."""
    rows = [(0, t // 3, "u", f"{t % 7}") for t in range(300)] + [(5, t // 3, "u", f"{t % 7}") for t in range(299)]
    rows += [(c, 0, "u", "0") for c in (1, 2, 3, 4, 8, 9)]
    check(spark, rows)


def test_many_conversations_share_one_turn_and_one_end(spark):
    rows = [(5 * c, 0, "u", "hello") for c in range(60)] + [(5 * c, 1, "u", f"{c}") for c in range(30)]
    check(spark, rows)


def test_empty_table_and_extra_columns(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(r[0], r[1], r[2], r[3], 1, "x") for r in rows_of(4, 8)]
    got = trie(spark.createDataFrame(rows, SCHEMA + ", depth int, n string")).select(*NAMES).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute([r[:4] for r in rows])))


def test_a_failed_check_goes_on_with_other_bases(spark, monkeypatch):
    """With base 1 a fingerprint knows no order, so unlike prefixes meet; the check must see it."""
    rows = [(0, 0, "u", "a"), (0, 1, "u", "b"), (5, 0, "u", "b"), (5, 1, "u", "a")]
    monkeypatch.setattr(prefix_trie, "BASES", ((1, 1), *prefix_trie.BASES))
    check(spark, rows)
    monkeypatch.setattr(prefix_trie, "BASES", ((1, 1),))
    with pytest.raises(ValueError):
        trie(spark.createDataFrame(rows, SCHEMA))


def test_small_strings_of_ids_give_the_same_digests(spark, monkeypatch):
    rows = [(5 * c, 0, "u", "hello") for c in range(200)]
    monkeypatch.setattr(prefix_trie, "CHUNK", 20)
    check(spark, rows)


def test_products_modulo_the_prime():
    rng = random.Random(1)
    x = [rng.randrange(PRIME) for _ in range(2000)] + [0, 1, PRIME - 1, PRIME - 1]
    y = [rng.randrange(PRIME) for _ in range(2000)] + [PRIME - 1, PRIME - 1, PRIME - 1, 1]
    got = times(np.array(x, dtype=np.uint64), np.array(y, dtype=np.uint64)).tolist()
    assert got == [a * b % PRIME for a, b in zip(x, y)]
    exponents = np.array([0, 1, 2, 3, 1000, 12345])
    assert power(x[0], exponents).tolist() == [pow(x[0], int(e), PRIME) for e in exponents]
