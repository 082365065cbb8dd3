"""Operator 12: prefix trie of conversations by range minima over sorted LCPs.

Each conversation is a sequence of turn digests.  Sequences are sorted, and
cut into blocks of neighbours.  In a block, the lengths of the common prefixes
of neighbours (LCPs) go into a sparse table of range minima.  Each candidate
prefix - the first d turns of a sequence - binary-searches on its own how far
to the left and to the right the minimum stays d or more, which gives its
interval of members without a stack.  All figures of a node are sums or minima
over its interval, so that nodes which reach over several blocks are added up
by the hash of their prefix.  Neighbouring blocks know each other's border
sequence, so that no prefix counts as new twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm._store import materialize
from clickmart.llm.simhash import _spread

#: Turns (and conversations) of a block.
BLOCK = 250_000
HEAD_TURNS, GROUP = 6, 100
_DIGEST = 16
_BASE = 0x5851F42D4C957F2D


def _digest(role: Column, text: Column) -> Column:
    """Hex digest of a turn; the role's length keeps role and text apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns in order, as structs of digest and chars (code points of the text)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.col("turn").cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(turn.isNotNull().alias("has"), F.coalesce(turn, F.lit(0)).alias("turn"), _digest(role, text).alias("digest"),
                 F.length(text).cast("long").alias("chars")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return ordered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))))


def rebuild(sequences: DataFrame) -> DataFrame:
    """Each conversation c starts with the first h turns of conversation c - c % 100, h = crc32(c) % 6, then has its own after its first h."""
    heads = (sequences.where(F.col("conv_id") % GROUP == 0)
             .select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, HEAD_TURNS - 1).alias("head")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS).cast("int")
    joined = sequences.join(heads, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("head_id"), "left")
    own = F.slice("turns", h + 1, F.size("turns"))
    start = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), h))
    return joined.select("conv_id", F.when(start.isNull(), own).otherwise(F.concat(start, own)).alias("turns"))


def _numbered(block: int):
    """Adds ``block``, numbers that ascend in the order of the partitions and rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, room = TaskContext.get().partitionId() << 32, block
        for b in batches:
            size = np.diff(b.column(2).offsets.to_numpy()) + 1
            out = np.empty(len(b), np.int64)
            i = 0
            while i < len(b):
                j = max(i + (room == block), int(i + np.searchsorted(np.cumsum(size[i:]), room, side="right")))
                out[i:j] = number
                room -= int(size[i:j].sum())
                i = j
                if i < len(b) or room <= 0:
                    number, room = number + 1, block
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=["conv_id", "key", "chars", "block"])
    return run


class SparseTable:
    """Minima over all ranges of 2**k neighbours."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            low, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-step], low[step:]))

    def minimum(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minima of the ranges [left, right]."""
        k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            table = self.levels[level]
            out[at] = np.minimum(table[left[at]], table[right[at] + 1 - (1 << level)])
        return out

    def reach_right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Largest r with all values in (at, r] at least ``least``, by binary search for each."""
        r, n = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(r + (1 << k) < n)
            go = fits[self.levels[k][r[fits] + 1] >= least[fits]]
            r[go] += 1 << k
        return r

    def reach_left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest l with all values in (l, at] at least ``least``."""
        left = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(left - (1 << k) >= 0)
            go = fits[self.levels[k][left[fits] - (1 << k) + 1] >= least[fits]]
            left[go] -= 1 << k
        return left


def common_prefix(a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of rows of digests: how many leading ones agree in each pair of ranges that start at a_at and b_at and have n."""
    k, of = _spread(np.zeros(len(n), np.int64), n)
    differ = np.flatnonzero((a[a_at[of] + k] != b[b_at[of] + k]).any(axis=1))
    start = np.cumsum(n) - n
    first = np.append(differ, len(k))[np.searchsorted(differ, start)] if len(k) else start
    return np.minimum(first - start, n)


def _digests(column) -> tuple[np.ndarray, np.ndarray]:
    """The digests of all sequences as pairs of 64-bit numbers, and where each sequence starts."""
    rows = column.to_pylist()
    at = np.concatenate([[0], np.cumsum([len(r) // _DIGEST for r in rows])]).astype(np.int64)
    return np.frombuffer(b"".join(rows), np.uint64).reshape(-1, 2), at


NODE = ("h1 long, h2 long, depth long, p1 long, p2 long, conv_id long, n_convs long, last_chars long, n_leaves long, "
        "chars long, new_chars long, before long, first_end long, ends string")
_NODE = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (x.split() for x in NODE.split(", "))])


def _sum(prefix: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return prefix[right + 1] - prefix[left]


def _nodes(rows: pa.Table, edges: pa.Table) -> pa.Table:
    """Part of each trie node that lies in a block of sorted sequences."""
    rows = rows.sort_by([("key", "ascending"), ("conv_id", "ascending")])
    n = len(rows)
    conv = rows.column("conv_id").to_numpy()
    digest, at = _digests(rows.column("key"))
    size = np.diff(at)
    chars = rows.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    # What the neighbours in sorted order share: inside the block, and with the border rows of the blocks beside it.
    lcp = np.full(n, -1, np.int64)
    lcp[1:] = common_prefix(digest, digest, at[:-2], at[1:-1], np.minimum(size[:-1], size[1:]))
    border = []
    for name, i in (("before", 0), ("after", n - 1)):
        key = edges.column(name)[0].as_py()
        if key is None:
            border.append(-1)
            continue
        other = np.frombuffer(key, np.uint64).reshape(-1, 2)
        border.append(int(common_prefix(other, digest, np.zeros(1, np.int64), at[i:i + 1], np.minimum(size[i:i + 1], len(other)))[0]))
    known = lcp.copy()
    known[0] = border[0]
    leaf = np.append(lcp[1:], border[1]) < size  # the next sequence does not go on from this one

    total = np.concatenate([[0], np.cumsum(chars)])
    table, ids = SparseTable(lcp), SparseTable(conv)
    depth, row = _spread(np.zeros(n, np.int64), size + 1)
    first_of = np.cumsum(size + 1) - (size + 1)
    left, right = table.reach_left(row, depth), table.reach_right(row, depth)
    node = np.flatnonzero(left == row)
    d, i, r = depth[node], row[node], right[node]

    # Hash of a prefix: sums of its digests times powers of its positions.
    place = np.arange(len(digest)) - np.repeat(at[:-1], size)
    longest = int(size.max()) if n else 0
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(longest + 1, _BASE, np.uint64))
        sums = np.zeros((len(digest) + 1, 2), np.uint64)
        np.cumsum(digest * power[place][:, None], axis=0, out=sums[1:])
        mine = (sums[at[i] + d] - sums[at[i]]).view(np.int64)
        above = (sums[at[i] + np.maximum(d - 1, 0)] - sums[at[i]]).view(np.int64)
    all_chars = total[at[1:]] - total[at[:-1]]
    new = total[at[1:]] - total[at[:-1] + np.maximum(known, 0)]
    all_sum, new_sum, leaf_sum = (np.concatenate([[0], np.cumsum(x)]) for x in (all_chars, new, leaf.astype(np.int64)))
    # At its first row a node counts only what is new from its own depth on.
    new_first = total[at[i + 1]] - total[at[i] + np.maximum(np.maximum(d - 1, known[i]), 0)]
    ends, firsts = [None] * len(node), np.zeros(len(node), np.int64)
    whole = np.flatnonzero(size[i] == d)
    # Equal sequences: the rows after it with nothing more; each is its own last prefix.
    last = np.searchsorted(np.cumsum(np.r_[True, (lcp[1:] < size[1:]) | (size[1:] != size[:-1])]), np.arange(1, n + 1), side="right") - 1
    group = np.cumsum(np.r_[True, (lcp[1:] < size[1:]) | (size[1:] != size[:-1])]) - 1
    for k in whole.tolist():
        a, b = int(i[k]), int(last[group[i[k]]])
        ends[k], firsts[k] = ",".join(map(str, conv[a:b + 1].tolist())), conv[a]
    last_chars = np.where(d > 0, total[at[i] + d] - total[at[i] + np.maximum(d - 1, 0)], 0)
    has_end = np.zeros(len(node), bool)
    has_end[whole] = True
    columns = [mine[:, 0], mine[:, 1], d, above[:, 0], above[:, 1], ids.minimum(i, r), r - i + 1, last_chars, _sum(leaf_sum, i, r),
               _sum(all_sum, i, r), _sum(new_sum, i + 1, r) + new_first, total[at[i] + np.maximum(d - 1, 0)] - total[at[i]]]
    return pa.Table.from_arrays([*map(pa.array, columns), pa.array(firsts, mask=~has_end), pa.array(ends, pa.string())], schema=_NODE)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids from chunks sorted by node and first id; only the running hash is held."""
    key, state = None, None
    for b in batches:
        out = []
        for h1, h2, depth, chunk in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 4))):
            if key == (h1, h2, depth):
                state.update(b",")
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (h1, h2, depth), hashlib.sha256()
            state.update(chunk.encode())
        yield _hashed(out)
    if key:
        yield _hashed([(*key, state.hexdigest())])


def _hashed(rows: list) -> pa.RecordBatch:
    kinds = {"h1": pa.int64(), "h2": pa.int64(), "depth": pa.int64(), "ends_sha256": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


def trie(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie's nodes of ``sequences`` (conv_id, turns), one row each.

    A node is a distinct sequence of first turns, the root the empty one.
    ``conv_id`` is its smallest member, ``parent_conv_id`` its parent's,
    ``n_convs`` counts the members, ``n_children`` the children, ``n_leaves``
    the childless nodes in its subtree; ``saved_tokens`` sums over its subtree
    (members - 1) times the code points of the node's last text, and
    ``ends_sha256`` hashes the ids of the members that end there.

    conv_id must be unique.  Turnless conversations end at the root.  An empty
    table gives no rows.  Turns are compared by 128-bit digests, prefixes by
    128-bit sums of these.  One conversation's digests (24 bytes a turn) are
    one row; a block holds about ``block`` turns, whatever prefixes they share.
    """
    flat = materialize(sequences.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"),
        F.transform("turns", lambda t: t["chars"]).alias("chars")), "sequences")
    # Equal sequences lie in the order of their ids, so that ids split them over partitions.
    sorted_rows = flat.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = materialize(sorted_rows.mapInArrow(_numbered(block), "conv_id long, key binary, chars array<long>, block long"), "sorted-sequences")
    border = blocks.groupBy("block").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    beside = Window.orderBy("block")  # one row for each block, that is, for some 250,000 turns
    edges = border.select("block", F.lag("high").over(beside).alias("before"), F.lead("low").over(beside).alias("after"))
    parts = materialize(blocks.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(_nodes, NODE), "node-parts")

    key = ("h1", "h2", "depth")
    merged = materialize(parts.groupBy(*key).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_leaves").alias("n_leaves"), (F.sum("chars") - F.sum("n_convs") * F.max("before") - F.sum("new_chars")).alias("saved_tokens")), "nodes")
    ends = (parts.where("ends is not null").select(*key, "first_end", "ends").repartition(*key).sortWithinPartitions(*key, "first_end")
            .mapInArrow(_hash_ends, "h1 long, h2 long, depth long, ends_sha256 string"))
    below = merged.where("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    above = merged.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256().hexdigest()
    return (merged.join(below, list(key), "left").join(ends, list(key), "left").join(above, ["p1", "p2", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Trie of the rebuilt ``conversations`` (conv_id, turn, role, text, any others).

    Turns are ordered by turn, null first, those with equal numbers by their
    digest; rows that repeat a turn are turns of their own.  Null role or text
    is empty.  Rows without conv_id belong to no conversation.  Other columns
    are left out.  An empty table gives no rows.
    """
    return trie(rebuild(turn_sequences(conversations)), block)
