"""Operator 13: spelling variants by a bit-sliced position index.

1. Words are counted over all documents.
2. Two words one edit apart agree in the first half of the shorter one or in
   the rest of it, so each word is dealt by both halves, for its own length
   and as the longer word of a pair.  A bucket that is too large is dealt
   again by the halves of the part that its words need not share.
3. A task lays its buckets one after the other and keeps, for each position
   and letter, a bitset of the words that have the letter there.  A query runs
   over its bucket's stretch of the bitsets, 64 words at once.  For each query
   letter it updates the words that agree so far, those with one replaced
   letter, and, against the letters one position further on, those with one
   letter more.
4. Each word's near words are counted and the most frequent is its form; forms
   are followed by pointer jumping.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import materialize
from clickmart.llm._words import U
from clickmart.llm.simhash import _spread

MIN_LENGTH, MIN_COUNT, RATIO, TYPO = 5, 3, 2, 97
#: Buckets with more letters are dealt again; a task indexes about ``BATCH`` letters at once.
PIECE, BATCH = 100_000, 1_000_000
#: Queries' 64-word steps worked on at once.
LANES = 1 << 16
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")


def _cuts(text: str, size: int = 1 << 18) -> Iterator[str]:
    """``text`` in parts of about ``size`` that cut no run of letters."""
    i = 0
    while i < len(text):
        end = _BREAK.search(text, min(i + size, len(text)))
        j = end.start() + 1 if end else len(text)
        yield text[i:j]
        i = j


def _with_typo(word: str, h: int) -> str:
    i = h % len(word)
    return word[:i] + word[i + 1:]


def count_runs(total: Counter, doc_id: int | None, text: str, typo: int = TYPO) -> None:
    """Adds the runs of a document to ``total``.

    A run whose crc32 with the document's id is a multiple of ``typo`` loses a letter, the same one at all its places in the document.
    """
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for part in _cuts(text.encode().lower().decode()):  # on bytes, lower() changes only A-Z
        runs = _RUN.findall(part)
        total.update(runs)
        hit = {w for w in set(runs) if zlib.crc32(w.encode(), start) % typo == 0}
        if hit:
            for w, n in Counter(w for w in runs if w in hit).items():
                total[w] -= n
                total[_with_typo(w, zlib.crc32(w.encode(), start))] += n


def _counted(flush: int = 200_000, typo: int = TYPO, shortest: int = MIN_LENGTH):
    """(word, n) of a task's documents; a part of the counts goes out whenever ``flush`` words are held."""
    def rows(total: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in total.items() if n > 0 and len(w) >= shortest]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                if text.is_valid:
                    count_runs(total, doc_id.as_py(), text.as_py(), typo)
                if len(total) >= flush:
                    yield rows(total)
                    total = Counter()
        yield rows(total)
    return run


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typo: int = TYPO) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) with at least ``min_length`` letters and ``min_count`` occurrences."""
    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_counted(typo=typo, shortest=min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ buckets
#: A bucket's words have ``l`` letters, or one more (``more`` 1); the first ``a`` and the last ``c`` agree.  Pairs that agree in their first ``x`` belong to another bucket.
STATE = ("word", "n", "more", "l", "a", "c", "x")


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice: its bucket's words that agree in the first half of the rest, and in the other half."""
    rest = F.col("l") - F.col("a") - F.col("c")
    half = F.floor(rest / 2).cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("c").alias("c"), F.col("x").alias("x"))
    other = F.struct(F.col("a").alias("a"), (F.col("c") + rest - half).alias("c"), (F.col("a") + half).alias("x"))
    out = rows.withColumn("s", F.explode(F.array(first, other))).select("word", "n", "more", "l", "s.*")
    last = F.col("word").substr(F.length("word") - F.col("c") + 1, F.col("c"))
    return out.withColumn("bucket", F.xxhash64("l", "a", "c", "x", F.col("word").substr(F.lit(1), F.col("a")), last))


def buckets(words: DataFrame, piece: int = PIECE) -> DataFrame:
    """Rows of STATE and ``bucket``, which bring every two words one edit apart together in exactly one bucket."""
    length = F.length("word")
    as_shorter = F.struct(F.lit(0).alias("more"), length.alias("l"))
    as_longer = F.struct(F.lit(1).alias("more"), (length - 1).alias("l"))
    rows = _halves(words.select("word", "n", F.explode(F.array(as_shorter, as_longer)).alias("r")).select("word", "n", "r.*")
                   .withColumns({"a": F.lit(0), "c": F.lit(0), "x": F.lit(-1)}))
    done = None
    while True:
        large = materialize(rows.groupBy("bucket").agg(F.sum(F.length("word")).alias("letters"), F.max(F.col("l") - F.col("a") - F.col("c")).alias("rest"))
                            .where((F.col("letters") > piece) & (F.col("rest") > 1)).select("bucket"), "large-buckets")
        last = large.isEmpty()
        small = rows if last else rows.join(large, "bucket", "left_anti")
        done = small if done is None else done.unionByName(small)
        if last:
            return done
        rows = _halves(materialize(rows.join(large, "bucket", "left_semi").select(*STATE), "dealt-again"))


# ------------------------------------------------------------------ index
class BitSlicedIndex:
    """Bitsets over words: for each position and letter the words that have it there."""

    def __init__(self, codes: np.ndarray, letters: int):
        """``codes``: a row of letter numbers for each word, 0 after its end."""
        n, self.width = codes.shape
        self.steps = -(-n // 64)
        self.bits = np.zeros((self.width, letters + 1, self.steps), np.uint64)
        for i in range(self.width):
            has = np.zeros((letters + 1, self.steps * 64), np.uint8)
            has[codes[:, i], np.arange(n)] = 1
            self.bits[i] = np.packbits(has, axis=1, bitorder="little").view(np.uint64)

    def one_edit(self, query: np.ndarray, step: np.ndarray, within: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For lanes of a query's letters and a 64-word step: words (bits) with one replaced letter, and with one letter more.

        ``within`` has the bits to look at.  Words that agree in the first ``other`` letters (-1: none) are left out.
        """
        exact, replaced = within.copy(), np.zeros_like(within)
        longer, left_out = within.copy(), np.zeros_like(within)
        for i in range(query.shape[1]):
            here, next_ = self.bits[i, query[:, i], step], self.bits[i + 1, query[:, i], step]
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
            longer = (longer & next_) | exact
            at = other == i + 1
            left_out[at] = exact[at]
        return replaced & ~left_out, longer & ~left_out


def _mask(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bits low to high - 1 of a 64-bit number (0 <= low < high <= 64)."""
    ones = U(0xFFFFFFFFFFFFFFFF)
    return (ones << low.astype(np.uint64)) & (ones >> (64 - high).astype(np.uint64))


def near_pairs(codes: np.ndarray, more: np.ndarray, bucket: np.ndarray, other: np.ndarray, length: int, letters: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, found) of words in the same bucket: each word of ``length`` letters with its near words of as many or one more.

    Rows are sorted by bucket; ``codes`` has ``length`` + 1 columns.
    """
    index = BitSlicedIndex(codes, letters)
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[start, len(bucket)])
    low, high = np.repeat(start, sizes), np.repeat(start + sizes, sizes)
    query = np.flatnonzero((more == 0) & (high - low > 1))
    first, last = low[query] // 64, (high[query] - 1) // 64 + 1
    total = np.concatenate([[0], np.cumsum(last - first)])
    has_more = np.packbits(np.pad(more, (0, -len(more) % 64)).astype(np.uint8), bitorder="little").view(np.uint64)
    i = 0
    while i < len(query):
        j = max(i + 1, int(np.searchsorted(total, total[i] + LANES, side="right")) - 1)
        step, of = _spread(first[i:j], last[i:j])
        q = query[i:j][of]
        within = _mask(np.maximum(low[q] - 64 * step, 0), np.minimum(high[q] - 64 * step, 64))
        replaced, longer = index.one_edit(codes[q, :length], step, within, other[q])
        hits = (replaced & ~has_more[step]) | (longer & has_more[step])
        lane = np.flatnonzero(hits)
        if len(lane):
            at, bit = np.nonzero(np.unpackbits(hits[lane].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield q[lane[at]], 64 * step[lane[at]] + bit
        i = j


def _letter_rows(words: list[str], width: int) -> tuple[np.ndarray, int]:
    """Letters as numbers in code-point order, 0 after a word's end, and how many there are."""
    raw = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    used = np.unique(raw)
    used = used[used > 0]
    codes = np.where(raw > 0, np.searchsorted(used, raw) + 1, 0)
    return codes.astype(np.uint32), len(used)


_PARTIAL = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _group(words: list[str], n: np.ndarray, more: np.ndarray, bucket: np.ndarray, other: np.ndarray, length: int) -> pa.RecordBatch:
    """Of buckets of one length: each word's near words there, their number and the most frequent."""
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    size = np.diff(np.r_[start, len(bucket)])
    # A bucket of one word, or with longer ones only, has no pair.
    use = np.flatnonzero(np.repeat((size > 1) & (np.add.reduceat(1 - more, start) > 0), size))
    words, n, more, bucket, other = [words[i] for i in use.tolist()], n[use], more[use], bucket[use], other[use]
    if not words:
        return pa.RecordBatch.from_arrays([pa.array([], kind) for kind in _PARTIAL.types], schema=_PARTIAL)
    codes, letters = _letter_rows(words, length + 1)
    # Rank: by n, largest first, then by code points.
    order = np.lexsort((*codes.T[::-1], -n))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    found, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    for q, hit in near_pairs(codes, more, bucket, other, length, letters):
        longer = more[hit] == 1
        for a, b in ((q, hit), (hit[longer], q[longer])):
            found += np.bincount(a, minlength=len(words))
            np.minimum.at(best, a, rank[b])
    at = np.flatnonzero(found)
    form = order[best[at]]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in at.tolist()], pa.string()), pa.array(n[at]), pa.array(found[at]), pa.array(n[form]),
         pa.array([words[i] for i in form.tolist()], pa.string())], schema=_PARTIAL)


def _near(hold: int = BATCH):
    """Partial results of rows (word, n, more, l, x, bucket) sorted by l and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        letters = 0

        def cut(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal parts, letters
            rows = pa.Table.from_batches(parts)
            length, bucket = rows.column("l").to_numpy(), rows.column("bucket").to_numpy()
            new = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (length[1:] != length[:-1])])
            end = len(rows) if whole else int(new[-1])  # the last bucket may go on
            rest = rows.slice(end)
            parts, letters = rest.to_batches(), int((rest.column("l").to_numpy() + 1).sum())
            n, more, other = (rows.column(c).to_numpy() for c in ("n", "more", "x"))
            i = 0
            while i < end:  # buckets of one length, about ``hold`` letters
                same = int(np.searchsorted(length[:end], length[i], side="right"))
                most = i + max(1, hold // (int(length[i]) + 1))
                j = same if most >= same else max(int(new[np.searchsorted(new, most, side="right") - 1]), int(np.append(new, end)[np.searchsorted(new, i) + 1]))
                yield _group(rows.column("word").slice(i, j - i).to_pylist(), n[i:j], more[i:j], bucket[i:j], other[i:j], int(length[i]))
                i = j

        for b in batches:
            parts.append(b)
            letters += int((b.column(3).to_numpy() + 1).sum())
            if letters >= hold:
                yield from cut(False)
        if parts and sum(map(len, parts)):
            yield from cut(True)
    return run


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: pointers are doubled until none moves.

    A form has at least ``ratio`` times its word's occurrences, so that the rounds are few: the logarithm of a logarithm of the largest number.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        to = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialize(now.join(to, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(words: DataFrame, ratio: int = RATIO, piece: int = PIECE) -> DataFrame:
    """Every word of ``words`` (word, n) with form, root, n, n_near and form_n."""
    dealt = buckets(words, piece).select("word", "n", "more", "l", "x", "bucket")
    parts = (dealt.repartition("l", "bucket").sortWithinPartitions("l", "bucket")
             .mapInArrow(_near(), "word string, n long, n_near long, form_n long, form string"))
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("k"), "form")))
    judged = (parts.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
              .withColumn("taken", F.col("b").isNotNull() & (-F.col("b.k") >= ratio * F.col("n"))))
    near = materialize(judged.select("word", F.when(F.col("taken"), F.col("b.form")).alias("form"), "n", "n_near",
                                     F.when(F.col("taken"), -F.col("b.k")).alias("form_n")), "near-words")
    roots = _roots(near.where("form is not null"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, typo: int = TYPO,
                      piece: int = PIECE) -> DataFrame:
    """Every word of ``docs`` (doc_id, text, any others) with its most frequent spelling: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters with A-Z lower-cased; in some
    (document, run) a letter is deleted, by the hash of the contract.  Words
    one edit apart are near; the form is the near word with the largest n (the
    first in code-point order of equal ones) if that is at least ``ratio``
    times the word's own; the root is the end of the chain of forms.

    Null text has no words; a null doc_id counts as an empty one; every row
    counts, repeated ones too.  Other columns are left out.  An empty table
    gives no rows.  Buckets are told apart by 64-bit hashes, words by
    themselves.  A word is held whole, whatever its length.
    """
    return group_variants(materialize(vocabulary(docs, min_length, min_count, typo), "vocabulary"), ratio, piece)
