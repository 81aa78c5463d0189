import pytest

from shapeloom.llm.line_dedup import dedup_lines

WS = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(rows, t):
    """Texts after deletion, by a table of every window's first place."""
    seq = {}
    for d, text in rows:
        seq[d, text] = [x.strip(WS) for x in (text or "").split("\n") if x.strip(WS)]
    order = sorted(seq, key=lambda k: (k[0] is not None, k[0] or 0))
    first = {}
    for k in order:
        for i in range(len(seq[k]) - t + 1):
            first.setdefault(tuple(seq[k][i:i + t]), (k, i))
    out = []
    for d, text in rows:
        s, gone = seq[d, text], set()
        for i in range(len(s) - t + 1):
            if first[tuple(s[i:i + t])] != ((d, text), i):
                gone |= set(range(i, i + t))
        kept, k = [], 0
        for line in (text or "").split("\n"):
            if line.strip(WS):
                k += 1
                if k - 1 in gone:
                    continue
            kept.append(line)
        out.append((d, None if text is None else "\n".join(kept), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("t", [1, 2, 4])
def test_equals_brute_force(spark, t):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = dedup_lines(docs, t).collect()
    want = brute([tuple(r) for r in docs.collect()], t)
    assert sorted([(r.doc_id, r.text, r._removed) for r in got], key=repr) == want
    assert any(n for *_, n in want)


@pytest.mark.parametrize("t", [1, 2])
def test_nulls_empties_repeats_and_extra_columns(spark, t):
    rows = [(1, "a\nb\nc", 1), (2, " a\nb \n\nc\nd", 1), (3, "d\na\nb\na\nb\na\nb", 1), (4, None, 1), (5, "", 1), (6, "\n \n", 1),
            (7, "a", 1), (7, "a", 1), (8, "p\nq\nr", 1), (8, "p\nq\nr", 1), (None, "c\nd", 1), (9, "z\n" * 100_000 + "end", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line int")
    got = dedup_lines(docs, t)
    assert got.columns == ["doc_id", "text", "line", "_removed"]
    assert sorted([(r.doc_id, r.text, r._removed) for r in got.collect()], key=repr) == brute([r[:2] for r in rows], t)
    assert dedup_lines(docs.limit(0), t).count() == 0


def test_one_repeated_line_goes_by_default(spark):
    docs = spark.createDataFrame([(1, "x\nshared line\ny"), (2, "p\nshared line\nq"), (3, "shared line")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in dedup_lines(docs).collect()) == [(1, "x\nshared line\ny"), (2, "p\nq"), (3, "")]


def test_columns_named_like_its_own(spark):
    names = ["_gone_id", "_gone_hash", "_numbers", "_row_id", "_row_hash", "_removed", "_NUMBERS_"]
    docs = spark.createDataFrame([(1, "a\nb", *range(7)), (2, "a", *range(7))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    got = dedup_lines(docs)
    assert got.columns == ["doc_id", "text", *names, "__removed"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\nb", *range(7), 0), (2, "", *range(7), 1)]


def test_a_line_in_most_documents(spark):
    """Its rows are more than 1/1024 of all, so they meet a broadcast."""
    rows = [(i, f"hot\nown {i}") for i in range(300)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted([(r.doc_id, r.text, r._removed) for r in got.collect()], key=repr) == brute(rows, 1)


def test_runs_beside_single_lines(spark):
    """Both rules in one call: single lines, and the runs that winnowing finds and extends."""
    rows = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\ny\nd"), (3, "d\na\nb\na\nb"), (4, None), (5, "b"), (None, "c\nd"), (7, "q\nb\nc\nd\nx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_lines(docs, runs=2)
    assert got.columns == ["doc_id", "text", "_removed", "_run_text", "_run_removed"]
    got = got.collect()
    assert sorted([(r.doc_id, r.text, r._removed) for r in got], key=repr) == brute(rows, 1)
    want = brute(rows, 2)
    assert sorted([(r.doc_id, r._run_text, r._run_removed) for r in got], key=repr) == want
    assert any(n for *_, n in want) and want != brute(rows, 1)
    with pytest.raises(ValueError):
        dedup_lines(docs, 2, runs=1)


def test_query_does_the_work_of_runs(spark):
    from shapeloom.llm.queries import op1_line_dedup
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = {r.doc_id: r for r in op1_line_dedup(spark, "/root/testdata/sf0.01").collect()}
    for t, column in ((1, "n_removed"), (2, "run_n_removed")):
        assert {d: got[d][column] for d in docs} == {d: n for d, _, n in brute(list(docs.items()), t)}
    assert 0 < sum(r.run_n_removed for r in got.values()) < sum(r.n_removed for r in got.values())
