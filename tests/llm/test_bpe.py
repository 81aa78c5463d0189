"""The prefix tables against the tokenizer library, edits against a whole new encoding, and exact round trips."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken

from shapeloom.llm import bpe
from shapeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BITS = ["a", "b", "e", "th", "in", "the", " ", "  ", "\n", "é", "你", "'", "'r", "e", "ve", "1", "23", "!", "\t", "　",
        "😀", "ß", "А", "ال", " ", "\x1c", "<|endoftext|>"]


@pytest.fixture(scope="module", params=[False, True], ids=["pattern", "segments"])
def vocabulary(request):
    with open(FILE, "rb") as f:
        return bpe.Vocabulary(bpe.read_ranks(f.read()), public_tokenizers.PATTERN, request.param)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def some_text(rng, most=40):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, most)))


def whole(vocabulary, text):
    return [i for w in bpe.Remembering(vocabulary).windows(text) for i in w]


def test_random_texts(vocabulary, library):
    rng = random.Random(1)
    for _ in range(3000):
        text = some_text(rng)
        ids = whole(vocabulary, text)
        assert ids == library.encode_ordinary(text), text
        assert vocabulary.decode(ids).decode() == text


def test_table_holds_the_last_token_of_every_prefix(vocabulary):
    for text in ("unbelievable", "internationalisation", "thetheththe", "你好你好吗"):
        piece = bpe.Piece(vocabulary, text)
        for i in range(1, len(piece.data) + 1):
            assert piece.last[i] == vocabulary.merged(piece.data[:i])[-1]


def test_boundaries_by_the_definition(vocabulary):
    rng = random.Random(2)
    ids = list(vocabulary.tokens)
    near = [i for i in ids if len(vocabulary.tokens[i]) < 4]
    for _ in range(20000):
        a, b = rng.choice(ids if rng.random() < 0.5 else near), rng.choice(ids if rng.random() < 0.5 else near)
        assert vocabulary.parted(a, b) == (vocabulary.merged(vocabulary.tokens[a] + vocabulary.tokens[b]) == [a, b])


def test_ranks_out_of_order_and_unreachable_tokens():
    ranks = {bytes([b]): 10 + b for b in range(256)}
    ranks |= {b"ab": 300, b"abc": 2, b"bc": 400, b"xyz": 500, b"cd": 1, b"dab": 301}
    own = bpe.Vocabulary(ranks, r"\S+|\s+")
    theirs = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    assert own.encode_piece("xyz") == (500,) and len(own.encode_piece("xyza")) == 4
    for _ in range(3000):
        text = "".join(rng.choice("abcdxyz ") for _ in range(rng.randint(0, 12)))
        assert whole(own, text) == theirs.encode_ordinary(text), text


@pytest.mark.parametrize("text", ["a" * 150_000, " " * 150_000, "'" * 70_000 + "re", "你好" * 40_000, "word " * 40_000 + "  \n" * 9])
def test_long_pieces_across_windows(vocabulary, library, text):
    ids = whole(vocabulary, text)
    assert vocabulary.decode(ids).decode() == text
    assert "".join(p for found in vocabulary.pieces(text) for p in found) == text
    if len(text) <= 150_000 and text[0] != "a":
        assert ids == library.encode_ordinary(text)


def test_windows_split_as_the_whole_text(vocabulary, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(bpe, "WINDOW", 7)
    for _ in range(1500):
        text = some_text(rng, 60)
        assert [p for found in vocabulary.pieces(text) for p in found] == vocabulary.pattern.findall(text)


def test_a_space_between_solid_characters_starts_a_piece(vocabulary, monkeypatch):
    """What ``space_starts`` promises of this pattern."""
    rng = random.Random(8)
    monkeypatch.setattr(bpe, "WINDOW", 9)
    spaces = [chr(c) for c in range(0x110000) if vocabulary.pattern.fullmatch("a" + chr(c) + "a") is None and chr(c).isspace()]
    for c in range(0x3100):
        if vocabulary.pattern.findall(f"a{chr(c)} ") == ["a", f"{chr(c)} "]:
            assert chr(c).isspace()  # the pattern's white space is Python's
    for _ in range(1500):
        text = "".join(rng.choice(BITS + spaces[:3]) for _ in range(rng.randint(0, 50)))
        cut = [s for found in bpe.segments(text) for s in found]
        assert "".join(cut) == text
        assert [p for s in cut for p in vocabulary.pattern.findall(s)] == vocabulary.pattern.findall(text), text


def test_appends_and_edits(vocabulary, library):
    rng = random.Random(5)
    for _ in range(150):
        text = some_text(rng)
        kept = bpe.EncodedText(vocabulary, text)
        for _ in range(12):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 5, 40]))
            new = some_text(rng, 6)
            if rng.random() < 0.3:
                kept.append(new)
                text += new
            else:
                kept.replace(a, b, new)
                text = text[:a] + new + text[b:]
            assert kept.text == text and kept.ids() == library.encode_ordinary(text), (text, a, b, new)


def test_an_edit_in_a_long_piece_keeps_both_ends(vocabulary):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    old = bpe.Piece(vocabulary, text)
    new = old.changed(text[:9000] + "zz" + text[9005:])
    assert new.recomputed < 500 and new.last == bpe.Piece(vocabulary, new.text).last


def test_query_equals_library(spark):
    with open(FILE, "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op12_byte_bpe"].build(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (
            len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((r.text or "").encode()).hexdigest())


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    with open(FILE, "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    tokenizer = bpe.Tokenizer(spark, FILE, public_tokenizers.PATTERN, space_starts=True)
    schema = "doc_id long, text string, ids string, data int"
    long = "thein " * 60_000 + "x" * 50_000
    rows = [(1, "a text", "x", 1), (1, "a text", "x", 1), (None, None, None, None), (2, "", "", 0), (3, long, "", 0)]
    docs = spark.createDataFrame(rows, schema)
    encoded = bpe.encode(docs, tokenizer)
    got = sorted(((r.doc_id or 0, r.ids) for r in encoded.collect()), key=lambda r: r[0])
    assert [r[1] for r in got[:4]] == [[], library.encode_ordinary("a text"), library.encode_ordinary("a text"), []]
    back = sorted((r.doc_id or 0, bytes(r.data).decode()) for r in bpe.decode(encoded, tokenizer).collect())
    assert back == sorted((r[0] or 0, r[1] or "") for r in rows)
    trip = {r.doc_id: r for r in bpe.round_trip(docs, tokenizer).collect()}
    assert trip[3].n_tokens == len(got[4][1]) and trip[None].n_tokens == 0 and trip[None].ids_sha256 == sha256(b"").hexdigest()
    assert trip[3].ids_sha256 == sha256(",".join(map(str, got[4][1])).encode()).hexdigest()
    none = spark.createDataFrame([], schema)
    assert bpe.encode(none, tokenizer).collect() == [] and bpe.round_trip(none, tokenizer).collect() == []
