"""Byte-level BPE by prefix dynamic programming, exact appends and edits, and decoding.

For every prefix of a piece of text its encoding has one last token. A token
``t`` that ends at byte ``i`` is that token if, and only if, it starts the
piece or the boundary between it and the last token of the prefix before it
outlives all merges. So ``last[i]`` follows from earlier entries, the tokens
are read backwards from the end, an append goes on where the table ends, and
an edit recomputes the table from the edit until it agrees with the old one.

Text is split into pieces by the vocabulary's pattern first, and no token
crosses pieces, as in the tokenizer libraries.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a text that are split into pieces at a time.
WINDOW = 1 << 16
#: A piece can depend on so many characters after its end (white space before a word, ``'re``).
MARGIN = 3
#: Texts and boundaries remembered by a worker, about, and the longest text remembered.
REMEMBERED, LONGEST = 500_000, 48
#: Pieces that begin with the same so many bytes share that part of their tables.
SHARED = 6
_NEVER = 1 << 62
_JOINT = re.compile(r"(?<=\S) (?=\S)")


class Vocabulary:
    """Tokens by rank; a token's id is its rank. Every single byte must be a token.

    ``space_starts`` says of the pattern that a space between two characters
    that aren't white space always starts a piece, whatever stands around
    them. Text can then be cut there before the pattern is matched.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, space_starts: bool = False):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.names = {i: str(i) for i in self.tokens}
        self.longest = max(map(len, ranks))
        self.pattern = regex.compile(pattern)
        self.space_starts = space_starts
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._spines: dict[int, tuple[list, list, bool]] = {}
        self._boundary: defaultdict[int, dict[int, bool]] = defaultdict(dict)  # by right token, then left
        self._boundaries = 0
        self._begun: dict[bytes, list[int]] = {}  # tables of the first SHARED bytes of pieces
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.merged(token) == [rank]:  # a token that no merges lead to stands only for a whole piece
                self._automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self._automaton.make_automaton()

    def merged(self, data: bytes, until: int = 1) -> list[int]:
        """The definition, for short bytes: join the neighbours of least rank, leftmost first, down to ``until`` parts."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > until:
            joined = [(self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(joined)
            if rank == _NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge is the last one of ``token``; None for a byte."""
        if token not in self._halves:
            data = self.tokens[token]
            self._halves[token] = None if len(data) == 1 else tuple(self.merged(data, 2))
        return self._halves[token]

    def _edges(self, token: int) -> tuple[list[int], list[int], bool]:
        """What stands at the token's left and right end while it is merged, first to last, and whether ranks rise on the way."""
        if token not in self._spines:
            both = []
            rising = True
            for side in (0, 1):
                edge, at = [token], token
                while self.halves(at):
                    rising &= max(self.halves(at)) < at
                    at = self.halves(at)[side]
                    edge.append(at)
                both.append(edge[::-1])
            self._spines[token] = (*both, rising)
        return self._spines[token]

    def parted(self, left: int, right: int) -> bool:
        """Whether the tokens of ``left + right`` are these two: no merge crosses the boundary.

        The ends that face each other are replayed in the order of their
        merges; a merge across them happens if its rank is below the next one
        of the left end (which stands further left, so wins ties) and not
        above the next one of the right end.
        """
        known = self._boundary[right].get(left)
        if known is not None:
            return known
        _, facing, rising = self._edges(left)
        opposite, _, rising_too = self._edges(right)
        if rising and rising_too:
            i = j = 0
            while True:
                next_left = facing[i + 1] if i + 1 < len(facing) else _NEVER
                next_right = opposite[j + 1] if j + 1 < len(opposite) else _NEVER
                across = self.ranks.get(self.tokens[facing[i]] + self.tokens[opposite[j]], _NEVER)
                if across < next_left and across <= next_right:
                    known = False
                    break
                if next_left == next_right == _NEVER:
                    known = True
                    break
                if next_left <= next_right:
                    i += 1
                else:
                    j += 1
        else:  # ranks out of order: by the definition
            known = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        if self._boundaries >= 4 * REMEMBERED:
            self._boundary.clear()
            self._boundaries = 0
        self._boundary[right][left] = known
        self._boundaries += 1
        return known

    def extend(self, data: bytes, last: list[int], agrees=None) -> None:
        """Go on with ``last`` (entry i: the last token of data[:i]) to the end of ``data``.

        Tokens come by their ends, longest first. ``agrees(i)`` may end it
        early: it is asked after each entry.
        """
        done = len(last) - 1
        before = max(0, done - self.longest + 1)
        boundary = self._boundary
        for end, (token, length) in self._automaton.iter(data[before:].decode("latin-1")):
            end += before
            if end < done:
                continue  # a known prefix, or a shorter token than the one found
            start = end + 1 - length
            if start:
                left = last[start]
                parted = boundary[token].get(left)
                if parted is None:
                    parted = self.parted(left, token)
                if not parted:
                    continue
            last.append(token)
            done += 1
            if agrees and agrees(done):
                return

    def tokens_of(self, data: bytes, last: list[int]) -> list[int]:
        out, i, tokens = [], len(data), self.tokens
        while i:
            token = last[i]
            out.append(token)
            i -= len(tokens[token])
        out.reverse()
        return out

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        begun = self._begun.get(data[:SHARED])
        if begun is None:
            begun = [-1]
            self.extend(data[:SHARED], begun)
            if len(self._begun) >= REMEMBERED:
                self._begun.clear()
            self._begun[data[:SHARED]] = begun
        last = begun.copy()
        if len(data) > SHARED:
            self.extend(data, last)
        return tuple(self.tokens_of(data, last))

    def pieces(self, text: str, start: int = 0) -> Iterator[list[str]]:
        """The pieces of text[start:], some at a time: windows are cut where a piece no longer depends on what follows."""
        at, width = start, WINDOW
        while at < len(text):
            found = self.pattern.findall(text, at, at + width)
            to = min(at + width, len(text))
            if to < len(text):
                safe = to - MARGIN
                while found and to > safe:
                    to -= len(found.pop())
            if found:
                yield found
                at, width = to, WINDOW
            else:
                width *= 2

    def decode(self, ids) -> bytes:
        """The bytes of any ids of this vocabulary (KeyError for another id)."""
        return b"".join(map(self.tokens.__getitem__, ids))


def segments(text: str) -> Iterator[list[str]]:
    """``text`` cut before each space that stands between two characters that aren't white space, some at a time."""
    at, width = 0, WINDOW
    while at < len(text):
        window = text[at:at + width]
        parts = window.split(" ")
        if "  " in window or window[-1] == " " or " ".join(map(str.strip, parts)) != window:
            parts = _JOINT.split(window)
        used = len(window)
        if at + width < len(text):  # what follows the window may belong to the last part
            used -= len(parts.pop()) + 1
        if used > 0:
            yield [parts[0], *[f" {p}" for p in parts[1:]]]
            at, width = at + used, WINDOW
        else:
            width *= 2


class Recent(dict):
    """key -> made(key) for the keys asked for of late.

    What was not asked for while REMEMBERED other keys came in is forgotten.
    """

    def __init__(self, made):
        super().__init__()
        self.made, self.older = made, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        value = self.older.get(key)
        if value is None:
            value = self.made(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Remembering:
    """A vocabulary with the tokens of recent pieces and segments."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = Recent(vocabulary.encode_piece)
        self.segments = Recent(self._segment)

    def _segment(self, segment: str) -> tuple[int, ...]:
        v = self.vocabulary
        found = v.pattern.findall(segment) if len(segment) <= WINDOW else chain.from_iterable(v.pieces(segment))
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, found)))

    def windows(self, text: str) -> Iterator[list[int]]:
        """The text's tokens, a window at a time."""
        cut, known = ((segments(text), self.segments) if self.vocabulary.space_starts
                      else (self.vocabulary.pieces(text), self.pieces))
        for found in cut:
            yield list(chain.from_iterable(map(known.__getitem__, found)))


class Piece:
    """One piece with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, text: str):
        self.vocabulary, self.text, self.data = vocabulary, text, text.encode("utf-8")
        self.last = [-1]
        vocabulary.extend(self.data, self.last)

    def changed(self, text: str) -> Piece:
        """The piece of another text: prefixes in common are kept, and entries after the change once they agree."""
        new = Piece.__new__(Piece)
        new.vocabulary, new.text, new.data = self.vocabulary, text, text.encode("utf-8")
        old, data = self.data, new.data
        same = _common(old, data)
        tail = _common(old[same:][::-1], data[same:][::-1])
        new.last = self.last[:same + 1]
        shift = len(old) - len(data)
        # the table agrees for good once `longest` entries in a row agree, past the change and its reach
        settled, run = len(data) - tail + self.vocabulary.longest, 0
        if tail <= self.vocabulary.longest:
            self.vocabulary.extend(data, new.last)
            return new

        def agrees(i):
            nonlocal run
            run = run + 1 if i >= settled and new.last[i] == self.last[i + shift] else 0
            return run > self.vocabulary.longest
        self.vocabulary.extend(data, new.last, agrees=agrees)
        new.recomputed = len(new.last) - 1 - same
        new.last.extend(self.last[len(new.last) + shift:])
        return new

    def ids(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.data)
        return [whole] if whole is not None else self.vocabulary.tokens_of(self.data, self.last)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


class EncodedText:
    """A text with its tokens, kept right under appends and edits.

    Only pieces near the edit are split again, and of those only the prefixes
    after it are encoded again. Places count code points.
    """

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, text
        self._pieces = [Piece(vocabulary, p) for p in chain.from_iterable(vocabulary.pieces(text))]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """text[start:end] becomes ``new``."""
        text = self.text[:start] + new + self.text[end:]
        first = at = 0
        while first < len(self._pieces) and at + len(self._pieces[first].text) + MARGIN <= start:
            at += len(self._pieces[first].text)
            first += 1
        ends, place = {}, at  # where old pieces after the edit end, in the new text
        for k in range(first, len(self._pieces)):
            place += len(self._pieces[k].text)
            if place >= end:
                ends[place - (end - start) + len(new)] = k + 1
        made, old, rest = [], first, len(self._pieces)
        for piece in chain.from_iterable(self.vocabulary.pieces(text, at)):
            made.append(self._pieces[old].changed(piece) if old < len(self._pieces) else Piece(self.vocabulary, piece))
            at += len(piece)
            old += 1
            if at in ends and at >= start + len(new):
                rest = ends[at]
                break
        self._pieces[first:rest] = made
        self.text = text

    def ids(self) -> list[int]:
        return [i for piece in self._pieces for i in piece.ids()]


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """token -> rank of a rank file: base64 of the token, a space, its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


_loaded: dict[str, Remembering] = {}


class Tokenizer:
    """A rank file (under ``path`` on the driver) and its pattern, usable in every task (see ``Vocabulary``).

    The file's bytes are broadcast: their size is the vocabulary's, whatever
    the input. A worker builds its tables once.
    """

    def __init__(self, spark, path: str, pattern: str, space_starts: bool = False):
        with open(path, "rb") as f:
            raw = f.read()
        self._held = spark.sparkContext.broadcast(raw)
        self._split = (pattern, space_starts)
        self._key = sha256(raw + repr(self._split).encode()).hexdigest()

    def here(self) -> Remembering:
        """The tables of this process."""
        if self._key not in _loaded:
            _loaded[self._key] = Remembering(Vocabulary(read_ranks(self._held.value), *self._split))
        return _loaded[self._key]

    def __getstate__(self):
        return {"_held": self._held, "_split": self._split, "_key": self._key}


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        raw = value.as_py()
        yield raw.decode("utf-8", "replace") if raw else ""


def _narrow(docs: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def encode(docs: DataFrame, tokenizer: Tokenizer, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int): the tokens of every whole text, a row per input row.

    A null or empty text has no tokens. Repeated rows get equal results, null
    ids stay, texts of any length are split window by window; an empty table
    gives no rows. Bytes that aren't UTF-8 count as U+FFFD. Special tokens are
    ordinary text. Columns beyond the two named are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        known = tokenizer.here()
        for batch in batches:
            for i, text in enumerate(_texts(batch.column(1))):
                ids = array("i", chain.from_iterable(known.windows(text)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([ids], pa.list_(pa.int32()))], schema=schema)
    return _narrow(docs, doc_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, tokenizer: Tokenizer, doc_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, data (binary): the bytes of every row's ids; null ids give none, an unknown id raises."""
    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])

    def run(batches):
        vocabulary = tokenizer.here().vocabulary
        for batch in batches:
            for i, ids in enumerate(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([vocabulary.decode(ids.as_py() or [])], pa.binary())], schema=schema)
    rows = encoded.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, data binary")


def round_trip(docs: DataFrame, tokenizer: Tokenizer, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded again window by window.

    Rows as in ``encode``; the ids and the decoded bytes of a text are never held whole.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batches):
        known = tokenizer.here()
        name, decoded = known.vocabulary.names.__getitem__, known.vocabulary.decode
        for batch in batches:
            rows = []
            for text in _texts(batch.column(1)):
                n, of_ids, of_bytes = 0, sha256(), sha256()
                for ids in known.windows(text):
                    of_ids.update(("," if n else "").encode() + ",".join(map(name, ids)).encode())
                    of_bytes.update(decoded(ids))
                    n += len(ids)
                rows.append((n, of_ids.hexdigest(), of_bytes.hexdigest()))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, [pa.int64(), pa.string(), pa.string()])],
                                             schema=schema)
    return _narrow(docs, doc_col, text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
