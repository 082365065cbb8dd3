"""Operator 6: SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints at most ``max_bits`` apart agree in at least one of
``max_bits + 1`` blocks of bits, so each distinct fingerprint is dealt once
for each block by the block's bits.  A bucket that is too large for a task is
dealt again, by ``max_bits + 1`` blocks of the bits that its members need not
share, until every bucket is small.  Within a bucket fingerprints are sorted by the rank of their bits in the Gray code, which puts similar ones
side by side.  Runs of neighbours become nodes that hold the bits on which
all of them agree; runs of nodes become upper nodes, and so on.  A search adds
up the differing bits from the root down, each bit counted at the highest node
that fixes it, and drops a whole group once the sum exceeds the limit, or
takes a whole group once it can no longer exceed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import materialize, without

U = np.uint64
ALL = U(0xFFFFFFFFFFFFFFFF)
FAN = 8
#: Buckets of more fingerprints are dealt again by further bits.
PIECE = 20_000


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a whole text: bit is 1 if set in over half the shingles' XXH64 values."""
    words = (text or "").encode().lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(line, seed)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lens) - 1
    starts = ends - lens + 1
    digest = xxhash.xxh64_digest
    joined = b"".join([digest(line[a:b], seed) for a, b in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())])
    bits = np.unpackbits(np.frombuffer(joined, np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros(64, np.int64)
    for i in range(0, len(bits), 1 << 15):
        total += bits[i:i + (1 << 15)].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(bits)).tobytes(), "big")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a bit pattern in the Gray code's sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U(s))
    return x


class GrayIndex:
    """Hierarchical index of fingerprints in one or more buckets.

    ``fps`` are sorted by (bucket, Gray rank); ``bucket`` numbers are ascending.
    Level 0 has the fingerprints; each upper level has one node for up to
    ``FAN`` neighbours of the level below in the same bucket, until every
    bucket has one root.
    """

    def __init__(self, fps: np.ndarray, bucket: np.ndarray, max_bits: int):
        self.max_bits = max_bits
        self.levels = [(fps, np.full(len(fps), ALL), np.arange(len(fps) + 1), bucket)]
        while True:
            pattern, mask, _, group = self.levels[-1]
            start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            place = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
            if not (place > 0).any():
                break
            first = np.flatnonzero(place % FAN == 0)
            size = np.diff(np.r_[first, len(group)])
            differ = np.bitwise_or.reduceat(pattern ^ np.repeat(pattern[first], size), first)
            shared = np.bitwise_and.reduceat(mask, first) & ~differ
            self.levels.append((pattern[first] & shared, shared, np.r_[first, len(group)], group[first]))
        self.roots = self.levels[-1][3]

    def first_leaf(self, level: int, node: np.ndarray) -> np.ndarray:
        for i in range(level, 0, -1):
            node = self.levels[i][2][node]
        return node

    def chains(self) -> tuple[np.ndarray, np.ndarray]:
        """Links of neighbours below the nodes whose members all lie within the limit of each other."""
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(1, len(self.levels)):
            _, mask, child, _ = self.levels[i]
            tight = np.flatnonzero(64 - np.bitwise_count(mask).astype(np.int64) <= self.max_bits)
            kids, of = _spread(child[tight], child[tight + 1])
            a.append(self.first_leaf(i, tight)[of])
            b.append(self.first_leaf(i - 1, kids))
        return np.concatenate(a), np.concatenate(b)

    def search(self, fps: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, leaf) within the limit.  A group that lies within it as a whole gives its first leaf."""
        at = np.minimum(np.searchsorted(self.roots, bucket), len(self.roots) - 1)
        known = np.flatnonzero(self.roots[at] == bucket)
        top = len(self.levels) - 1
        for i in range(0, len(known), 1 << 15):
            q = known[i:i + (1 << 15)]
            yield from self._down(fps, q, at[q], np.zeros(len(q), np.int64), np.zeros(len(q), np.uint64), top)

    def _down(self, fps, q, node, acc, fixed, level) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``fixed``: the bits that upper nodes have counted into ``acc``."""
        pattern, mask, child, _ = self.levels[level]
        acc = acc + np.bitwise_count((fps[q] ^ pattern[node]) & mask[node] & ~fixed)
        keep = acc <= self.max_bits
        q, node, acc = q[keep], node[keep], acc[keep]
        free = 64 - np.bitwise_count(mask[node]).astype(np.int64)
        whole = acc + free <= self.max_bits
        # Below a whole group's node all members are linked by chains().
        yield q[whole], self.first_leaf(level, node[whole])
        if level:
            q, node, acc = q[~whole], node[~whole], acc[~whole]
            for i in range(0, len(q), 1 << 17):
                part = slice(i, i + (1 << 17))
                kids, of = _spread(child[node[part]], child[node[part] + 1])
                yield from self._down(fps, q[part][of], kids, acc[part][of], mask[node[part]][of], level - 1)


def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges, and for each the number of its range."""
    n = end - start
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[of], of


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 the smallest node of each one's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        high = np.maximum(label[a], label[b])
        apart = low < high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label != label[label]).any():
            label = label[label]
    return label


def _link_bucket_rows(max_bits: int, hold: int = 200_000):
    """Of rows (mask, value, fp) sorted by bucket: each fingerprint linked to the smallest one of its part of the bucket."""
    def linked(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        if not len(fps):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["u", "v"])
        bucket = np.cumsum(np.r_[0, (key[1:] != key[:-1]).any(axis=1).astype(np.int64)])
        order = np.lexsort((gray_rank(fps & ~key[:, 0].view(np.uint64)), bucket))
        fps, bucket = fps[order], bucket[order]
        index = GrayIndex(fps, bucket, max_bits)
        label = smallest_linked(len(fps), *index.chains())
        for q, found in index.search(fps, bucket):
            # Fold each batch of pairs into the labels; pairs are never all held.
            a, b = label[q], label[found]
            if (a != b).any():
                label = smallest_linked(len(fps), np.r_[np.arange(len(fps)), a], np.r_[label, b])
        # Name each part by its smallest fingerprint.
        name = np.full(len(fps), ALL)
        np.minimum.at(name, label, fps)
        name = name[label]
        out = name != fps
        return pa.RecordBatch.from_arrays([pa.array(fps[out].view(np.int64)), pa.array(name[out].view(np.int64))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0

        def cut(whole: bool):
            nonlocal parts, rows
            table = np.concatenate([np.zeros((0, 3), np.int64), *parts])
            if not whole:  # the last bucket may go on
                key = table[:, :2]
                end = len(key) - np.flatnonzero((key[::-1] != key[-1]).any(axis=1))[0] if (key != key[-1]).any() else 0
                parts, rows = [table[end:]], len(table) - end
                table = table[:end]
            return linked(table[:, :2], table[:, 2].view(np.uint64))

        for b in batches:
            parts.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1).copy())
            rows += len(parts[-1])
            if rows >= hold:
                yield cut(False)
        yield cut(True)

    return run


def _further(mask: int, blocks: int) -> list[int]:
    """``mask`` with each of ``blocks`` blocks of the bits that it has not, as signed 64-bit numbers."""
    free = [i for i in range(64) if not mask >> i & 1]
    edges = [len(free) * i // blocks for i in range(blocks + 1)]
    out = [mask % 2**64 | sum(1 << i for i in free[a:b]) for a, b in zip(edges, edges[1:])]
    return [m - 2**64 if m >> 63 else m for m in out]


def buckets(fps: DataFrame, max_bits: int = 3, piece: int = PIECE) -> DataFrame:
    """Rows (mask, value, fp) that bring any two fingerprints at most ``max_bits`` apart together in a bucket (mask, value).

    ``value`` is the bits of ``fp`` at ``mask``.  A bucket's members share
    those, so that the bits by which two of them differ leave one of
    ``max_bits + 1`` blocks of the other bits equal: a bucket of more than
    ``piece`` members is dealt again by these, which makes ``max_bits + 1``
    rows of each.  None is left larger unless all its members lie within the limit.
    """
    blocks = max_bits + 1
    masks, rows, done = [0], fps.select(F.lit(0).cast("long").alias("mask"), "fp"), None
    while True:
        further = {m: _further(m, blocks) for m in masks}
        deal = F.create_map(*[x for m, ms in further.items() for x in (F.lit(m).cast("long"), F.array(*[F.lit(n).cast("long") for n in ms]))])
        rows = (rows.select(F.explode(F.element_at(deal, F.col("mask"))).alias("mask"), "fp")
                .select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("value"), "fp"))
        # At most rows / piece buckets.  Those whose other bits are no more than the limit need no splitting.
        large = materialize(rows.groupBy("mask", "value").count().where((F.col("count") > piece) & (64 - F.bit_count("mask") > max_bits))
                            .select("mask", "value"), "large-buckets")
        masks = [r["mask"] for r in large.select("mask").distinct().collect()]
        small = rows.join(large, ["mask", "value"], "left_anti") if masks else rows
        done = small if done is None else done.unionByName(small)
        if not masks:
            return done
        rows = materialize(rows.join(large, ["mask", "value"], "left_semi").select("mask", "fp"), "dealt-again")


def link_fingerprints(fps: DataFrame, max_bits: int = 3, piece: int = PIECE) -> DataFrame:
    """Links (u, v), v < u as unsigned, that connect exactly the distinct fingerprints ``fp`` at most ``max_bits`` apart.

    Each part of a bucket that is connected in itself gives a star, not all its pairs.
    """
    rows = buckets(fps, max_bits, piece).repartition("mask", "value").sortWithinPartitions("mask", "value")
    return rows.mapInArrow(_link_bucket_rows(max_bits), "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of ``links`` (u, v long) the smallest node it is connected to.

    Alternates large-star and small-star steps; each round is a written table.
    A round's work is in proportion to the links, and the rounds to the
    logarithm of the longest path's length.
    """
    def oriented(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    def state(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()

    now = materialize(oriented(links), "links")
    was = state(now)
    while was["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = oriented(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .unionByName(low.select("u", F.col("m").alias("v"))))
        now = materialize(small, "links")
        if (is_ := state(now)) == was:
            break
        was = is_
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def doc_key() -> Column:
    """Equal for rows that agree in doc_id and text."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 3) -> DataFrame:
    """For every row of ``docs``: doc_id, doc_key, fp (signed 64-bit fingerprint), component_id and first_key.

    ``component_id`` is the smallest doc_id among all documents reachable over
    links of at most ``max_bits`` differing bits, itself included (null if
    none has an id).  ``first_key`` is the doc_key of one document of the
    component: with the smallest doc_id, then the smallest key.  Null and
    empty texts have fingerprint 0 and are linked like any other.  Columns
    besides doc_id and text are left out.
    """
    @F.arrow_udf("long")
    def fingerprints(text: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), size) for t in text], np.uint64).view(np.int64))

    # Text is hashed once; from here on only ids, keys and fingerprints move.
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("doc_key"),
                                   fingerprints(F.col("text").cast("string")).alias("fp")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key")
    classes = materialize(rows.groupBy("fp").agg(F.min(order).alias("first")), "fingerprint-classes")
    roots = components(link_fingerprints(classes.select("fp"), max_bits))
    named = classes.join(roots, classes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    of_fp = named.select("fp", "root").join(firsts, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.doc_key").alias("first_key"))
    return rows.join(of_fp, "fp").select("doc_id", "doc_key", "fp", "component_id", "first_key")


def keep_first(docs: DataFrame, size: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component; of rows that repeat doc_id and text one stays."""
    first = near_duplicates(docs, size, max_bits).select(F.col("first_key").alias("__first")).distinct()
    keyed = docs.withColumn("__key", doc_key())
    kept = keyed.join(first, keyed["__key"] == first["__first"], "left_semi")
    return kept.dropDuplicates(["__key"]).drop("__key")
