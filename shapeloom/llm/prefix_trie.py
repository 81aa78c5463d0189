"""Prefix trie of conversations rebuilt from other conversations' heads.

The fingerprint of a sequence of turns is an element of a monoid: its length,
its bytes, and two polynomial hashes modulo 2**61 - 1. The product of two
elements is that of the joined sequence, and heads can be divided out. So the
running products over the original turns, one scan whatever the conversations'
lengths, give the fingerprints of all prefixes of all rebuilt conversations:
head of the base times (own prefix divided by own head). No rebuilt text or
turn list is made; a rebuilt turn is a reference to a stored turn's SHA-256.

Nodes are groups of equal (depth, fingerprint). Each group is checked through
its references: its members' last turns must have one digest and their parents
one fingerprint, so by induction members agree in every turn. If a check ever
fails, all is done again with other hash bases.

Sums over subtrees need no walk over the tree. Let c be the smallest member of
the nodes on its path from depth first(c) on. A subtree's distinct turns are,
summed over its members, the turns each adds as a smallest member; so what is
saved below node u is the sum over members c of the bytes between u and
first(c). Leaves are counted at their smallest member in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import owner_join
from .storage import run_dir, written

PRIME = (1 << 61) - 1
#: Pairs of hash bases, tried in order.
BASES = ((0x0F1E2D3C4B5A6978, 0x123456789ABCDEF1), (0x0ABCDEF012345677, 0x0FEDCBA987654321),
         (0x1A2B3C4D5E6F7081, 0x0102030405060709))
#: Bytes of conversation ids that are hashed at a time.
CHUNK = 1 << 20
KEY = ["depth", "a", "b"]
_LOW31, _LOW30, _P = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1), np.uint64(PRIME)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x * y modulo 2**61 - 1 for arrays of reduced uint64."""
    xh, xl, yh, yl = x >> np.uint64(31), x & _LOW31, y >> np.uint64(31), y & _LOW31
    middle = xh * yl + xl * yh
    return _reduced(np.uint64(2) * xh * yh + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + xl * yl)


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2**61 - 1."""
    out = np.ones(len(exponents), dtype=np.uint64)
    left, square = exponents.astype(np.uint64), base % PRIME
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = times(out[odd], np.full(int(odd.sum()), square, dtype=np.uint64))
        left >>= np.uint64(1)
        square = square * square % PRIME
    return out


def _u(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _turn_values(q0: np.ndarray, q1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash values of turns, from two words of their digests."""
    return _reduced(q0 >> np.uint64(2)), _reduced(q1 >> np.uint64(2))


def stored_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, digest (SHA-256 of role and text), size (bytes of the text); rows without conv_id are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    tagged = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.unhex(F.sha2(tagged, 256)).alias("digest"), F.octet_length(text).cast("long").alias("size")).where("conv_id is not null")


_STATE = "length bigint, bytes bigint, a bigint, b bigint"
_DIGEST = "q0 bigint, q1 bigint, q2 bigint, q3 bigint"


def _running(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """Running products within each conversation and task, of turns dealt by range, and each task's first and last conversation.

    kind 0: a turn with the product up to it; 1: the product of the task's
    last conversation; 2: the conversation with which the task starts.
    """
    one, two = bases

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        current, length, size, a, b = None, 0, 0, 0, 0
        names = ["kind", "task", "conv_id", "length", "bytes", "a", "b", "q0", "q1", "q2", "q3", "size"]

        def rows(kind, convs, states, digests, sizes):
            n = len(convs)
            columns = [np.full(n, kind), np.full(n, task), convs, *(list(zip(*states)) or [()] * 4), *digests.T, sizes]
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, dtype=np.int64)) for c in columns], names=names)
        nothing = np.zeros((1, 4), dtype=np.int64)
        for batch in batches:
            digests = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<i8").reshape(-1, 4)
            values = _turn_values(digests[:, 0].view(np.uint64), digests[:, 1].view(np.uint64))
            convs, sizes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            states = []
            for conv, u, v, s in zip(convs, values[0].tolist(), values[1].tolist(), sizes):
                if conv != current:
                    if current is None:
                        yield rows(2, [conv], [(0, 0, 0, 0)], nothing, [0])
                    current, length, size, a, b = conv, 0, 0, 0, 0
                length, size, a, b = length + 1, size + s, (a * one + u) % PRIME, (b * two + v) % PRIME
                states.append((length, size, a, b))
            yield rows(0, convs, states, digests, sizes)
        if current is not None:
            yield rows(1, [current], [(length, size, a, b)], nothing, [0])
    # equal rows of one turn may stand in several tasks: the last key only parts them
    ordered = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "apart"]
    dealt = turns.withColumn("apart", F.monotonically_increasing_id()).repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    return dealt.select("conv_id", "digest", "size").mapInArrow(
        run, f"kind bigint, task bigint, conv_id bigint, {_STATE}, {_DIGEST}, size bigint")


def _carries(running: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """What the turns of a task's first conversation that stand in earlier tasks multiply to: at most a row per task."""
    one, two = bases

    def walk(edges: pd.DataFrame) -> pd.DataFrame:  # a row or two per task that holds the conversation
        out, state = [], (0, 0, 0, 0)
        for e in edges.sort_values(["task", "kind"], ascending=[True, False]).itertuples():
            if e.kind == 2:
                if state[0]:
                    out.append((e.task, e.conv_id, *state))
            else:
                n = int(e.length)
                state = (state[0] + n, state[1] + int(e.bytes), (state[2] * pow(one, n, PRIME) + int(e.a)) % PRIME,
                         (state[3] * pow(two, n, PRIME) + int(e.b)) % PRIME)
        return pd.DataFrame(out, columns=["task", "conv_id", "c_length", "c_bytes", "c_a", "c_b"]).astype("int64")
    edges = running.where("kind > 0").select("kind", "task", "conv_id", "length", "bytes", "a", "b")
    return edges.groupBy("conv_id").applyInPandas(
        walk, "task bigint, conv_id bigint, c_length bigint, c_bytes bigint, c_a bigint, c_b bigint")


def prefixes(turns: DataFrame, bases: tuple[int, int], folder: str) -> DataFrame:
    """Every stored turn with the product of its conversation up to it: conv_id, length, bytes, a, b, digest words, size."""
    one, two = bases
    running = written(_running(turns, bases), folder, "running")
    names = ["conv_id", "length", "bytes", "a", "b", "q0", "q1", "q2", "q3", "size"]

    def carried(batches):
        for batch in batches:
            c = dict(zip(batch.schema.names, batch.columns))
            length = c["length"].to_numpy()
            a = _reduced(times(_u(c["c_a"]), power(one, length)) + _u(c["a"]))
            b = _reduced(times(_u(c["c_b"]), power(two, length)) + _u(c["b"]))
            new = {"length": length + c["c_length"].to_numpy(), "bytes": c["bytes"].to_numpy() + c["c_bytes"].to_numpy(),
                   "a": a.view(np.int64), "b": b.view(np.int64)}
            yield pa.RecordBatch.from_arrays([pa.array(new[n]) if n in new else c[n] for n in names], names=names)
    # one row per task at most: bounded by the number of shuffle partitions
    own = running.where("kind = 0")
    carry = F.broadcast(written(_carries(running, bases), folder, "carries"))
    moved = own.join(carry, ["task", "conv_id"]).mapInArrow(carried, f"conv_id bigint, {_STATE}, {_DIGEST}, size bigint")
    return own.join(carry, ["task", "conv_id"], "left_anti").select(*names).unionByName(moved)


def _rebuilt(turns: DataFrame, bases: tuple[int, int], period: int, heads: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """(conversations, rebuilt turns with their prefixes' and parents' fingerprints)."""
    one, two = bases
    most = heads - 1
    first = F.struct("length", "bytes", "a", "b", "q0", "q1", "q2", "q3", "size")
    convs = turns.groupBy("conv_id").agg(
        F.max("length").alias("n"), F.max("bytes").alias("own_bytes"),
        F.sort_array(F.collect_list(F.when(F.col("length") <= most, first))).alias("firsts"))
    convs = written(convs.withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads,
        "base": F.col("conv_id") - F.col("conv_id") % period}), folder, "convs")
    base = convs.select(F.col("conv_id").alias("base"), F.col("firsts").alias("base_firsts"))  # shared by `period` at most
    at = lambda array, i, field: F.when(F.col(i) > 0, F.element_at(array, F.col(i).cast("int"))[field]).otherwise(F.lit(0))
    plans = convs.join(base, "base", "left").withColumn(
        "k", F.least(F.col("h"), F.coalesce(F.size("base_firsts"), F.lit(0)).cast("long")))
    plans = plans.withColumn("head", F.when(F.col("k") > 0, F.slice("base_firsts", F.lit(1), F.col("k").cast("int"))))
    plans = plans.withColumns({"has_own": F.col("n") > F.col("h"), **{f"base_{f}": at("base_firsts", "k", f) for f in ("bytes", "a", "b")}})
    plans = plans.withColumns({f"own_{f}": F.when(F.col("has_own"), at("firsts", "h", f)).otherwise(F.lit(0))
                               for f in ("a", "b")} | {
        "cut_bytes": F.when(F.col("has_own"), at("firsts", "h", "bytes")).otherwise(F.lit(0))})
    plans = plans.withColumns({
        "turns": F.col("k") + F.when(F.col("has_own"), F.col("n") - F.col("h")).otherwise(F.lit(0)),
        "total": F.col("base_bytes") + F.when(F.col("has_own"), F.col("own_bytes") - F.col("cut_bytes")).otherwise(F.lit(0))})
    plans = written(plans.drop("firsts", "base_firsts", "base"), folder, "plans")

    plain = ["conv_id", "turns", "total"]
    words = ["q0", "q1", "q2", "q3", "size"]
    head = plans.select(*plain, F.explode("head").alias("t")).select(
        *plain, F.col("t.length").alias("depth"), "t.bytes", "t.a", "t.b", *[f"t.{w}" for w in words],
        *[F.lit(0).cast("long").alias(c) for c in ("past", "base_a", "base_b", "own_a", "own_b")])
    mine = plans.where("has_own").select(*plain, "n", "h", "k", "base_bytes", "base_a", "base_b", "own_a", "own_b", "cut_bytes")
    own = owner_join(turns, mine, ["conv_id"], "n").where("length > h").select(
        *plain, (F.col("length") - F.col("h") + F.col("k")).alias("depth"),
        (F.col("base_bytes") + F.col("bytes") - F.col("cut_bytes")).alias("bytes"), "a", "b", *words,
        (F.col("length") - F.col("h")).alias("past"), "base_a", "base_b", "own_a", "own_b")
    names = [*plain, *KEY, "bytes", "size", "pa", "pb", "q0", "q1", "q2", "q3"]

    def run(batches):
        for batch in batches:
            c = dict(zip(batch.schema.names, batch.columns))
            past = c["past"].to_numpy()
            new = {}
            for f, base, value in zip("ab", (one, two), _turn_values(_u(c["q0"]), _u(c["q1"]))):
                change = _reduced(_u(c[f"base_{f}"]) + _P - _u(c[f"own_{f}"]))
                whole = _reduced(times(change, power(base, past)) + _u(c[f]))
                inverse = np.full(len(past), pow(base, -1, PRIME), dtype=np.uint64)
                new[f] = whole.view(np.int64)
                new[f"p{f}"] = times(_reduced(whole + _P - value), inverse).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(new[n]) if n in new else c[n] for n in names], names=names)
    schema = ("conv_id bigint, turns bigint, total bigint, depth bigint, a bigint, b bigint, bytes bigint, size bigint, "
              f"pa bigint, pb bigint, {_DIGEST}")
    return plans, written(own.unionByName(head).mapInArrow(run, schema), folder, "rebuilt")


def _verified(rebuilt: DataFrame, folder: str) -> DataFrame | None:
    """Nodes with members and smallest member; None if turns of unlike digests or parents share a fingerprint."""
    alike = ["q0", "q1", "q2", "q3", "size", "bytes", "pa", "pb"]
    one = F.lit(True)
    for c in alike:
        one = one & (F.min(c) == F.max(c))
    nodes = written(rebuilt.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.min(F.col("bytes") - F.col("size")).alias("before"),
        F.sum((F.col("depth") == F.col("turns")).cast("long")).alias("ends"), one.alias("one")), folder, "groups")
    return None if nodes.where("not one").limit(1).count() else nodes


def _ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ending conversations, numbers rising and comma-joined.

    The ids are sorted over all tasks and become strings of bounded size, and
    one task runs through a node's strings in order: SHA-256 is sequential, so
    a node's ids can be streamed but not split.
    """
    names = [*KEY, "first", "ids"]

    def strings(batches):
        key, first, ids, size = None, None, [], 0
        out = []

        def flush():
            if ids:
                out.append((*key, first, ",".join(ids)))
        for batch in batches:
            for d, a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (d, a, b) != key or size > CHUNK:
                    flush()
                    key, first, ids, size = (d, a, b), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    def digests(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for d, a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if (d, a, b) != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (d, a, b), sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*KEY, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], names=[*KEY, "ends_sha256"])
    ordered = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    chunks = ordered.mapInArrow(strings, "depth bigint, a bigint, b bigint, first bigint, ids string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        digests, "depth bigint, a bigint, b bigint, ends_sha256 string")


def trie(conversations: DataFrame, period: int = 5, heads: int = 9, conv_col: str = "conv_id", turn_col: str = "turn",
         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, from the textless root on.

    Conversation c is the first h turns of conversation c - c % period (h is
    crc32 of c's digits modulo ``heads``; the sign of c % period is c's), then
    its own turns after its first h. Columns: conv_id (smallest member), depth,
    parent_conv_id (the parent's conv_id, null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the fingerprint a, b.

    Turns are ordered by ``turn``, null first; equal ones by role, then by the
    SHA-256 of the turn. Rows equal in all are turns of their own. Null role
    and text are empty; rows without conv_id are no conversation's and are left
    out. Texts of any length enter by their digest and size only. An empty
    table gives no rows, not even a root. Only the four named columns are read.
    """
    spark = conversations.sparkSession
    for bases in BASES:
        folder = run_dir(spark, "trie")
        turns = written(prefixes(stored_turns(conversations, conv_col, turn_col, role_col, text_col), bases, folder),
                        folder, "prefixes")
        plans, rebuilt = _rebuilt(turns, bases, period, heads, folder)
        nodes = _verified(rebuilt, folder)
        if nodes is not None:
            return _measured(plans, rebuilt, nodes, folder)
    raise ValueError("prefixes of unlike turns share fingerprints under all hash bases")


def _measured(plans: DataFrame, rebuilt: DataFrame, groups: DataFrame, folder: str) -> DataFrame:
    zero = F.lit(0).cast("long")
    # where a conversation starts to be the smallest member, and whether it stands for a leaf
    leads = groups.groupBy("conv_id").agg(F.min("depth").alias("leads_from"), F.min("before").alias("before"),
                                          F.max((F.col("ends") == F.col("n")).cast("long")).alias("leaf"))
    leads = plans.select("conv_id", "turns", "total").join(leads, "conv_id", "left").select(
        "conv_id", "turns", F.coalesce("before", "total").alias("shared_bytes"), F.coalesce("leaf", zero).alias("leaf"),
        F.coalesce("leads_from", F.col("turns") + 1).alias("leads_from"))
    leads = written(leads, folder, "leads")
    each = owner_join(rebuilt.drop("turns"), leads.where("turns > 0").withColumn("rows", F.col("turns")), ["conv_id"], "rows")
    ends = F.sum((F.col("depth") == F.col("turns")).cast("long"))
    above = F.col("bytes") - F.col("size")
    nodes = each.groupBy(*KEY).agg(
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        ends.alias("ends"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.col("shared_bytes") - above, zero)).alias("saved_tokens"), F.min("leads_from").alias("leads_from"))
    root = leads.agg(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("pa"),
        F.lit(None).cast("long").alias("pb"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum((F.col("turns") == 0).cast("long")).alias("ends"), F.greatest(F.sum("leaf"), F.lit(1)).alias("n_leaves"),
        F.sum("shared_bytes").alias("saved_tokens"), zero.alias("leads_from")).where("n_convs > 0")
    nodes = written(nodes.unionByName(root), folder, "nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    ended = rebuilt.where("depth = turns").select(*KEY, "conv_id").unionByName(
        leads.where("turns = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id"))
    whole = nodes.join(children, KEY, "left").join(_ends_digests(ended), KEY, "left")
    whole = written(whole.withColumns({"n_children": F.coalesce("n_children", zero),
                                       "ends_sha256": F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest()))}), folder, "whole")
    # only where a conversation starts to lead is the parent's smallest member another one
    parents = whole.where("n_children > 0").select(
        F.col("depth").alias("p_depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"), "n_children")
    starts = whole.where("depth > 0 and depth = leads_from").withColumn("p_depth", F.col("depth") - 1)
    named = owner_join(starts, parents.withColumnRenamed("n_children", "rows"), ["p_depth", "pa", "pb"], "rows")
    rest = whole.where("depth = 0 or depth <> leads_from").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "a", "b"]
    return named.select(*names).unionByName(rest.select(*names))
