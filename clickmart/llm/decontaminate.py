"""Operator 8: benchmark decontamination with training suffix arrays.

The documents of a batch form a shard.  Its suffix array lists the positions
of its words in the order of the words that follow; all suffixes that start
with the same words are then one range, which two binary searches find.  Every
suffix of every benchmark item is searched in every shard, which gives its
verbatim occurrences.  Suffixes whose first words stand nowhere in the
benchmark side by side can match no test suffix and are left out of the array;
test suffixes whose first words stand nowhere in the shard side by side occur
nowhere in it and need no search.

A benchmark of more than one block takes a pass over the documents for each
block; a pass writes what it found, and the blocks' finds are added up by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from clickmart.llm._store import materialize, without
from clickmart.llm._words import ALNUM, LOWER, hashes, slices, utf8, words

WINDOW = 13
OUT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "items")


class TestSuffixes:
    """Every suffix of a block of benchmark items, cut to the window's length.

    Words are numbered from 1 by their hashes, so a suffix is a row of numbers.
    """

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW):
        buf, offsets = utf8(pa.array(texts, pa.string()))
        buf = LOWER[buf[offsets[0]:offsets[-1]]]
        starts, ends, first = words(buf, offsets - offsets[0], ALNUM)
        h = hashes(buf, starts, ends)
        self.window = window
        self.vocabulary = np.unique(h)
        number = np.searchsorted(self.vocabulary, h) + 1
        self.items = ids
        n_words = np.diff(first)
        # An item's windows start at its words but the last window - 1; a shorter item is one window.
        n_rows = np.where(n_words > 0, np.maximum(n_words - window + 1, 1), 0)
        self.item = np.repeat(np.arange(len(ids)), n_rows)
        at = np.arange(n_rows.sum()) - np.repeat(np.cumsum(n_rows) - n_rows, n_rows) + first[:-1][self.item]
        self.length = np.minimum(window, n_words[self.item])
        self.rows = np.zeros((len(at), window), np.int32)
        for k in range(window):
            inside = k < self.length
            self.rows[inside, k] = number[at[inside] + k]
        #: Words, and pairs of words, that an occurrence can start with, and the suffixes of each.
        lead = np.where(self.length == 1, _lead(self.rows[:, 0], _ANY), _lead(self.rows[:, 0], self.rows[:, 1]))
        self.by_lead = np.argsort(lead, kind="stable")
        self.leads, start = np.unique(lead[self.by_lead], return_index=True)
        self.lead_start = np.append(start, len(lead))

    def occurring(self, leads: np.ndarray) -> np.ndarray:
        """The suffixes, in order, that start with one of some words or pairs of words."""
        if not len(self.leads):
            return np.zeros(0, np.int64)
        leads = np.unique(leads)
        at = np.minimum(np.searchsorted(self.leads, leads), len(self.leads) - 1)
        at = at[self.leads[at] == leads]
        n = self.lead_start[at + 1] - self.lead_start[at]
        return np.sort(self.by_lead[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.lead_start[at], n)])


#: Stands for any second word (no block has so many words).
_ANY = (1 << 31) - 1


def _lead(word: np.ndarray, follows) -> np.ndarray:
    """One number for a word and the one after it."""
    return word.astype(np.int64) << 32 | follows


def suffix_array(number: np.ndarray, first: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted suffixes of a shard (cut to the window), their positions, and the test suffixes that may occur.

    ``number``: the shard's words, 0 if not in the benchmark; ``first``: first
    word of each document.  Words beyond the document's end count as 0.
    """
    ends = np.repeat(first[1:], np.diff(first))
    follows = np.append(number[1:], 0)
    follows[first[1:][(first[1:] > 0) & (first[1:] <= len(number))] - 1] = 0
    pair, single = _lead(number, follows), _lead(number, _ANY)
    two, one = np.isin(pair, tests.leads), np.isin(single, tests.leads)
    at = np.flatnonzero(two | one)
    rows = np.zeros((len(at), tests.window), np.int64)
    for k in range(tests.window):
        inside = at + k < ends[at]
        rows[inside, k] = number[at[inside] + k]
    order = np.lexsort(rows.T[::-1])
    return rows[order], at[order], tests.occurring(np.r_[pair[two], single[one]])


def _bounds(array: np.ndarray, test: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By binary search: for each test row the range of sorted rows that agree with its first ``length`` numbers."""
    n, width = array.shape
    low, high = np.zeros(len(test), np.int64), np.full(len(test), n)
    out = []
    for strict in (False, True):
        lo, hi = low.copy(), high.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            sign = np.zeros(len(open_), np.int64)
            for k in range(width):
                undecided = (sign == 0) & (k < length[open_])
                sign = np.where(undecided, np.sign(array[mid, k] - test[open_, k]), sign)
            below = sign < 0 if not strict else sign <= 0
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
        out.append(lo)
    return out[0], out[1]


def search_shard(h: np.ndarray, first: np.ndarray, tests: TestSuffixes):
    """Occurrences of all test suffixes: (position, words, item) arrays, and the
    longest verbatim match from each position on."""
    none = np.zeros(0, np.int64)
    if not len(h) or not len(tests.rows):
        return none, none, none, none
    at = np.minimum(np.searchsorted(tests.vocabulary, h), len(tests.vocabulary) - 1)
    number = np.where(tests.vocabulary[at] == h, at + 1, 0)
    rows, position, may = suffix_array(number, first, tests)
    low, high = _bounds(rows, tests.rows[may], tests.length[may])
    found = high - low
    which = np.repeat(may, found)
    place = position[np.arange(found.sum()) + np.repeat(low - np.cumsum(found) + found, found)]
    # Occurrences of neighbouring suffixes of an item add up to its longest match.
    run = place - which
    order = np.lexsort((place, run, tests.item[which]))
    place, which, run = place[order], which[order], run[order]
    doc_end = np.repeat(first[1:], np.diff(first))[place]
    new = np.r_[True, (run[1:] != run[:-1]) | (place[1:] != place[:-1] + 1) | (tests.item[which][1:] != tests.item[which][:-1])
                | (doc_end[1:] != doc_end[:-1])] if len(place) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    last = np.r_[start[1:], len(place)] - 1 if len(place) else none
    longest = np.repeat(place[last] + tests.length[which[last]], np.diff(np.r_[start, len(place)])) - place if len(place) else none
    return place, tests.length[which], tests.item[which], longest


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = 8 << 20, window: int = WINDOW) -> Iterator[TestSuffixes]:
    """Test suffixes in blocks of items, dealt by a hash, of about ``block_bytes`` of text on average.

    The driver holds one block at a time, whatever the size of the benchmark.
    Rows that repeat item and text count once; null texts have no words.
    """
    rows = materialize(benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                       .distinct(), "benchmark-items")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    for k in range(n_blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k).toArrow()
        if len(part):
            yield TestSuffixes(part.column("item").to_pylist(), part.column("text").to_pylist(), window)


_FOUND = "struct<n_words: long, spans: array<struct<at: int, until: int>>, longest: long, items: array<string>>"


def _matcher(block):
    """UDF of a text: its words, the spans of words inside an occurrence, longest match and items, of one broadcast block."""
    @F.arrow_udf(_FOUND)
    def matched(text: pa.Array) -> pa.Array:
        data, offsets = utf8(text)
        tests = block.value
        n_words, n_spans, longest, items = [], [], [], []
        spans = [(np.zeros(0, np.int32), np.zeros(0, np.int32))]
        for i, j in slices(offsets, 2 << 20):
            buf = LOWER[data[offsets[i]:offsets[j]]]
            starts, ends, first = words(buf, offsets[i:j + 1] - offsets[i], ALNUM)
            h = hashes(buf, starts, ends)
            of_word = np.repeat(np.arange(j - i), np.diff(first))
            cover = np.zeros(len(h) + 1, np.int64)
            best = np.zeros(j - i, np.int64)
            found: list[set] = [set() for _ in range(j - i)]
            place, length, item, longer = search_shard(h, first, tests)
            np.add.at(cover, place, 1)
            np.add.at(cover, place + length, -1)
            np.maximum.at(best, of_word[place], longer)
            for p in np.unique(of_word[place] << 32 | item).tolist():
                found[p >> 32].add(tests.items[p & 0xFFFFFFFF])
            hit = np.cumsum(cover)[:len(h)] > 0
            # A span ends where its words, or its document, end.
            new_doc = np.r_[True, of_word[1:] != of_word[:-1]] if len(h) else np.zeros(0, bool)
            a = np.flatnonzero(hit & (new_doc | ~np.r_[False, hit[:-1]][:len(h)]))
            z = np.flatnonzero(hit & (np.r_[new_doc[1:], True][:len(h)] | ~np.r_[hit[1:], False][:len(h)])) + 1
            spans.append(((a - first[of_word[a]]).astype(np.int32), (z - first[of_word[a]]).astype(np.int32)))
            n_spans += np.bincount(of_word[a], minlength=j - i).tolist()
            n_words += np.diff(first).tolist()
            longest += best.tolist()
            items += [sorted(x for x in s if x is not None) for s in found]
        at, until = (pa.array(np.concatenate(x)) for x in zip(*spans))
        bounds = pa.array(np.concatenate([[0], np.cumsum(n_spans)]).astype(np.int32))
        spans = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([at, until], ["at", "until"]))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), spans, pa.array(longest, pa.int64()), pa.array(items, pa.list_(pa.string()))],
            ["n_words", "spans", "longest", "items"])

    return matched


@F.arrow_udf(LongType())
def _count_words(text: pa.Array) -> pa.Array:
    data, offsets = utf8(text)
    out = []
    for i, j in slices(offsets, 2 << 20):
        out += np.diff(words(LOWER[data[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i], ALNUM)[2]).tolist()
    return pa.array(out, pa.int64())


def _covered(spans: Column) -> Column:
    """Words in the union of spans."""
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), empty, lambda s, x: F.struct(
        F.greatest(s["end"], x["until"]).alias("end"),
        (s["n"] + F.greatest(x["until"] - F.greatest(s["end"], x["at"]), F.lit(0))).alias("n")), lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_percent: int = 5,
                  block_bytes: int = 8 << 20) -> DataFrame:
    """Every row of ``docs`` (text, any others) with its verbatim benchmark matches.

    Adds n_words, n_hit (words inside an occurrence of a window of an item),
    n_items, items (sorted item ids, null ids left out), items_sha256,
    longest_match (words) and contaminated (n_hit > 0 and at least
    min_percent of n_words).  An item shorter than the window is one window.  Null text has
    no words.  An empty benchmark hits nothing.  Repeated rows are judged
    alike; input columns named like an output are replaced.

    Each batch of documents is a shard.  With one block of benchmark items
    (``block_bytes``) nothing is shuffled.  With more, blocks are broadcast
    one after another: a pass over all documents writes what the block hits
    (one row for each different text that it hits) and the block is
    destroyed before the next.  Driver and workers hold one block at a time,
    so a larger benchmark costs passes, not memory.  The hits of all passes
    are joined to the documents by a 128-bit hash of the text.
    """
    context = docs.sparkSession.sparkContext
    kept = without(docs, *OUT)
    text = F.col("text").cast("string")
    blocks = benchmark_blocks(benchmark, block_bytes, window)
    block, following = next(blocks, None) or TestSuffixes([], [], window), next(blocks, None)
    if following is None:
        found = kept.withColumn("__found", _matcher(context.broadcast(block))(text))
    else:
        hits = None
        while block is not None:
            shared = context.broadcast(block)
            one = (docs.select(F.md5(text.cast("binary")).alias("__text"), _matcher(shared)(text).alias("f")).where(F.size("f.spans") > 0)
                   .groupBy("__text").agg(F.first("f.spans").alias("spans"), F.first("f.longest").alias("longest"), F.first("f.items").alias("items")))
            one = materialize(one, "benchmark-hits")
            shared.destroy()
            hits = one if hits is None else hits.unionByName(one)
            block, following = following, next(blocks, None)
        # At most one row for each block and text.
        hits = hits.groupBy("__text").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.max("longest").alias("longest"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        found = (kept.withColumn("__text", F.md5(text.cast("binary"))).join(hits.select("__text", F.struct("*").alias("__hits")), "__text", "left")
                 .withColumn("__found", F.struct(
                     _count_words(text).alias("n_words"), F.coalesce("__hits.spans", F.array()).alias("spans"),
                     F.coalesce("__hits.longest", F.lit(0)).alias("longest"), F.coalesce("__hits.items", F.array()).alias("items"))))
    return (found.select(*kept.columns, F.col("__found.n_words").alias("n_words"), _covered(F.col("__found.spans")).alias("n_hit"),
                         F.size("__found.items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("__found.items", ",").cast("binary"), 256).alias("items_sha256"),
                         F.col("__found.longest").alias("longest_match"), F.col("__found.items").alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_percent * F.col("n_words"))))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows."""
    return contamination(docs, benchmark, **options).where("not contaminated").select(*docs.columns)
