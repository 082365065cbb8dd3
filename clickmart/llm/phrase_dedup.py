"""Operator 3: substring dedup with repeated-phrase automata.

1. Every window of ``WINDOW`` words has a seed: the run of ``SEED`` words in
   it with the smallest hash.  Equal windows have equal seeds at the same
   place, so only windows whose seed recurs can recur.  Documents are dealt
   into blocks by a hash, and seeds are counted by block over all documents.
2. A seed of two or more blocks recurs.  Its first block gives the phrase: the
   seed's words.  A join by seed brings each phrase to the blocks that may hold it.
3. Each block compiles the phrases it was sent into one Aho-Corasick automaton
   and streams its documents through it.  The words decide: a phrase that
   shares only its hash with a place in the block is not found there.  The
   automata are thus sharded by block, each bounded by the block's text.
4. Of the windows around the located phrases, the first of each content in the
   block goes, as a hash, to the task of its content, where all but the first
   occurrence over all blocks are marked.
5. Marks return to the block, which adds its own repeats (all but the first of
   each content in it), and the words under marked windows go.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.llm._store import without
from clickmart.llm._words import SPACED, U, grams, hashes, slices, utf8, words

WINDOW, SEED = 20, 8
OUT = ("n_words", "n_removed", "kept_text")
_KEY, _BLOCK = "__phrase_key", "__phrase_block"
_WIDTH = WINDOW - SEED + 1  # seeds in a window


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours (width - 1 fewer values)."""
    have = 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def seeds(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of word hashes and the documents' first words: the seed hash at each
    position, the first words of the whole windows, and each window's seed (smallest hash) value."""
    g = grams(h, SEED)
    if len(h) < WINDOW:
        return g, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.repeat(first[1:], np.diff(first))[:len(h) - WINDOW + 1]
    whole = np.flatnonzero(np.arange(len(ends)) + WINDOW <= ends)
    return g, whole, _sliding(g, _WIDTH, np.minimum)[whole]


def seed_positions(g: np.ndarray, whole: np.ndarray, smallest: np.ndarray, n: int) -> np.ndarray:
    """Positions that are the seed of some window (all of equally small ones)."""
    if not len(whole):
        return np.zeros(0, np.int64)
    low = np.zeros(n + 2 * _WIDTH, np.uint64)
    low[whole + _WIDTH - 1] = smallest
    # A position is in the windows that start at most _WIDTH - 1 words before it.
    high = _sliding(low, _WIDTH, np.maximum)[:len(g)]
    return np.flatnonzero((high == g) & (high > 0))


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, block): seeds of a batch's documents, one row for each block."""
    for b in batches:
        data, offsets = utf8(b.column(0))
        block = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in slices(offsets):
            buf, bounds = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            starts, ends, first = words(buf, bounds, SPACED)
            h = hashes(buf, starts, ends)
            g, whole, smallest = seeds(h, first)
            at = seed_positions(g, whole, smallest, len(h))
            of = np.repeat(block[i:j], np.diff(first))[at]
            seed = g[at].view(np.int64)
            order = np.lexsort((of, seed))
            seed, of = seed[order], of[order]
            new = np.flatnonzero(np.r_[True, (seed[1:] != seed[:-1]) | (of[1:] != of[:-1])]) if len(seed) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(seed[new]), pa.array(of[new].astype(np.int32))], names=["seed", "block"])


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (seed, block) sorted by both: each seed of two or more blocks with its first block.

    Nothing but the last seed, its first block and whether it went out is held.
    """
    held = None
    for b in batches:
        seed, block = (b.column(k).to_numpy().astype(np.int64) for k in range(2))
        if not len(seed):
            continue
        sent = False
        if held is not None:
            seed, block, sent = np.r_[held[0], seed], np.r_[held[1], block], held[2]
        new = np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]])
        several = np.maximum.reduceat(block, new) > block[new]
        out = several.copy()
        out[0] &= not sent
        yield pa.RecordBatch.from_arrays([pa.array(seed[new][out]), pa.array(block[new][out].astype(np.int32))], names=["seed", _BLOCK])
        held = seed[new[-1]], block[new[-1]], bool(several[-1]) or (sent and len(new) == 1)


class Block:
    """The distinct documents of a block, their words and word hashes."""

    def __init__(self, docs: pa.Table):
        ids = list(zip(docs.column("doc_id").to_pylist(), docs.column(_KEY).to_pylist()))
        rows = dict(zip(ids, docs.column("text").to_pylist()))
        number = {k: i for i, k in enumerate(rows)}
        self.row_doc = np.array([number[k] for k in ids], np.int64)  # document of each row
        self.has_id = np.array([i is not None for i, _ in rows], bool)
        self.doc_id = np.array([i or 0 for i, _ in rows], np.int64)
        self.key = np.array([k for _, k in rows], np.int64)
        parts = [b" " + b" ".join((t or "").encode().split()) + b" \n" for t in rows.values()]
        self.text = b"".join(parts)
        buf = np.frombuffer(self.text, np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.starts, self.ends, self.first = words(buf, bounds, SPACED)
        self.h = hashes(buf, self.starts, self.ends)
        self.doc = np.repeat(np.arange(len(parts)), np.diff(self.first))

    def phrases(self, seeds_: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The seeds that stand in the block, and the words of each one's first place, joined by one space."""
        g = grams(self.h, SEED)
        same = self.doc[:len(g)] == self.doc[SEED - 1:] if len(g) else np.zeros(0, bool)
        at = np.flatnonzero(same & np.isin(g, seeds_))
        found, first = np.unique(g[at], return_index=True)
        at = at[first]
        return found, [self.text[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at + SEED - 1].tolist())]

    def locate(self, phrases: list[bytes]) -> np.ndarray:
        """For each word whether one of ``phrases`` starts there, by one automaton over the block."""
        found = np.zeros(len(self.h) + 1, bool)
        if not phrases:
            return found
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in phrases:
            automaton.add_word(f" {phrase.decode('latin-1')} ")
        automaton.make_automaton()
        # A phrase has a space before and after it; the match ends at the latter.
        hits = np.fromiter((end for end, _ in automaton.iter(self.text.decode("latin-1"))), np.int64)
        found[np.searchsorted(self.ends, hits) - SEED + 1] = True
        return found

    def later(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contents of the windows that start at ``whole``, and whether each repeats one before it (by doc_id, key and start) in the block."""
        content = grams(self.h, WINDOW)[whole]
        again = np.zeros(len(whole), bool)
        order = np.argsort(content)
        equal = content[order][1:] == content[order][:-1]
        some = order[np.r_[equal, False] | np.r_[False, equal]] if len(whole) else order
        rank = np.empty(len(self.key), np.int64)
        rank[np.lexsort((self.key, self.doc_id, ~self.has_id))] = np.arange(len(self.key))
        some = some[np.lexsort((whole[some], rank[self.doc[whole[some]]], content[some]))]
        again[some[1:]] = content[some[1:]] == content[some[:-1]]
        return content, again


def _phrases(block_docs: pa.Table, homes: pa.Table) -> pa.Table:
    """(seed, phrase): the words of the seeds whose first block this is."""
    found, phrases = np.zeros(0, np.uint64), []
    if len(block_docs) and len(homes):
        found, phrases = Block(block_docs).phrases(homes.column("seed").to_numpy().view(np.uint64))
    return pa.table({"seed": pa.array(found.view(np.int64)), "phrase": pa.array(phrases, pa.binary())})


def _first_smallest(g: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Position of each window's smallest seed, the first of equal ones."""
    best = whole.copy()
    for k in range(1, _WIDTH):
        better = g[whole + k] < g[best]
        best[better] = whole[better] + k
    return best


#: Rows to the windows' tasks.
_SEGMENT = "content long, doc_id long, key long, start int"
_ARROW = pa.schema([("content", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])


def _segments(block_docs: pa.Table, routed: pa.Table) -> pa.Table:
    """The windows of a block whose seed is one of the phrases sent to it, the first of each content in the block."""
    empty = _ARROW.empty_table()
    if not len(block_docs) or not len(routed):
        return empty
    b = Block(block_docs)
    g, whole, _ = seeds(b.h, b.first)
    located = b.locate(routed.column("phrase").to_pylist())
    # A window's seed is one of its positions with a located phrase, or it cannot recur elsewhere.
    near = np.concatenate([[0], np.cumsum(located)])
    whole = whole[near[whole + _WIDTH] > near[whole]]
    whole = whole[located[_first_smallest(g, whole)]]
    content, again = b.later(whole)
    whole, content = whole[~again], content[~again]
    doc = b.doc[whole]
    return pa.Table.from_arrays([
        pa.array(content.view(np.int64)), pa.array(b.doc_id[doc], mask=~b.has_id[doc]), pa.array(b.key[doc]),
        pa.array((whole - b.first[doc]).astype(np.int32))], schema=_ARROW)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by content and place: all windows but the first of each content.

    Of earlier rows only the last one's content is held.
    """
    last = None
    for b in batches:
        if not len(b):
            continue
        content = b.column("content").to_numpy()
        again = np.r_[last == content[0], content[1:] == content[:-1]]
        last = content[-1]
        yield b.select(["key", "start"]).filter(pa.array(again))


def _strip(block_docs: pa.Table, marks: pa.Table) -> pa.Table:
    """The block's rows with counts and kept words; marked are ``marks`` and the windows that repeat an earlier one of the block."""
    out = block_docs.drop_columns([_BLOCK, _KEY])
    b = Block(block_docs)
    _, whole, _ = seeds(b.h, b.first)
    _, again = b.later(whole)
    # Documents by key; equal keys of different documents would need a collision of 64 bits within the block.
    by_key = np.argsort(b.key)
    sent = by_key[np.searchsorted(b.key[by_key], marks.column("key").to_numpy())] if len(marks) else np.zeros(0, np.int64)
    start = np.r_[whole[again], b.first[sent] + marks.column("start").to_numpy()]
    cover = np.zeros(len(b.h) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + WINDOW, -1)
    gone = np.cumsum(cover)[:-1] > 0
    before = np.concatenate([[0], np.cumsum(gone)])
    n_words, n_removed = np.diff(b.first), np.diff(before[b.first])
    kept = []
    for d, (i, j) in enumerate(zip(b.first[:-1].tolist(), b.first[1:].tolist())):
        if i == j:
            kept.append("")
        elif not n_removed[d]:
            kept.append(b.text[b.starts[i]:b.ends[j - 1]].decode())
        else:
            stay = np.flatnonzero(~gone[i:j]) + i
            kept.append(b" ".join([b.text[x:y] for x, y in zip(b.starts[stay].tolist(), b.ends[stay].tolist())]).decode())
    of = b.row_doc
    for name, values, kind in (("n_words", n_words[of], pa.int64()), ("n_removed", n_removed[of], pa.int64()),
                               ("kept_text", [kept[d] for d in of.tolist()], pa.string())):
        out = out.append_column(name, pa.array(values, kind))
    return out


def _block_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def remove_repeats(docs: DataFrame, block_bytes: int = 2 << 20) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, any others) with n_words, n_removed and kept_text.

    A window is 20 consecutive words of one document; a word goes if a window
    over it has the same words as one that starts earlier (in a document with
    a smaller doc_id, or earlier in the same one), judged on the input.
    ``kept_text`` is the kept words, joined by one space.

    Null text has no words.  Documents without id come last, those with equal
    ids in the order of a hash of their text; rows that repeat both are one
    document and get the same result.  Input columns named like an output are
    replaced.  An empty table gives no rows.

    Windows are compared by 64-bit hashes, phrases by their words.  Text is
    shuffled once (the three block steps read the same exchange); seeds, about
    one for every seven words, the phrases of those of several blocks, one row
    for each block and different window around such a phrase, and the marks
    are the other shuffles.
    """
    base = without(docs, *OUT).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, total // block_bytes)
    keyed = base.withColumn(_KEY, _block_key()).withColumn(_BLOCK, F.pmod(F.col(_KEY), F.lit(n_blocks)).cast("int"))
    texts = keyed.groupBy(_BLOCK)
    counted = keyed.select("text", _BLOCK).mapInArrow(_seed_rows, "seed long not null, block int not null").repartition("seed")
    # In each seed's task, as a stream: the seeds of two or more blocks, with the first of these.
    homes = counted.sortWithinPartitions("seed", "block").mapInArrow(_homes, f"seed long, {_BLOCK} int")
    phrases = texts.cogroup(homes.groupBy(_BLOCK)).applyInArrow(_phrases, "seed long not null, phrase binary not null")
    routed = (counted.join(phrases, "seed").groupBy("seed", "block").agg(F.first("phrase").alias("phrase"))
              .select(F.col("block").alias(_BLOCK), "phrase"))
    segments = texts.cogroup(routed.groupBy(_BLOCK)).applyInArrow(_segments, _SEGMENT)
    # A window's task gets at most one row of it from each block, however many documents share its seed.
    marks = (segments.repartition("content").sortWithinPartitions("content", F.col("doc_id").asc_nulls_last(), "key", "start")
             .mapInArrow(_mark, "key long, start int")
             .withColumn(_BLOCK, F.pmod(F.col("key"), F.lit(n_blocks)).cast("int")))
    schema = T.StructType([*base.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return texts.cogroup(marks.groupBy(_BLOCK)).applyInArrow(_strip, schema)
