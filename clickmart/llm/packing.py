"""Operator 7: sequence packing, shortest pack first over the length histogram.

Documents become token ids and are cut every ``size`` ids.  Only the histogram
of piece lengths (at most ``size`` numbers) reaches the driver.  Lengths are
placed longest first, each into the packs that are shortest so far; packs of
the same filling are one pattern with a count, so the work depends on the
number of lengths, not of documents.  Patterns go back to the pieces by rank:
the k-th piece of a length takes the k-th place that the patterns have for it.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm._store import materialize

SIZE, END_ID = 2048, 1
#: Below this code point the two tokenizer libraries class all characters alike (tested).
PLAIN_BELOW = 0x530


@lru_cache(maxsize=2)
def load_encoder(path: str):
    """``encode(text) -> uint32 ids`` equal to the tokenizer file's own encoding without added special tokens.

    A byte-level BPE file whose vocabulary is in merge order and whose split is
    the usual byte-level one is also a rank table, which encodes several times
    faster; texts with a special token or an uncommon character go through the
    tokenizer itself, as do all texts of another kind of file.
    """
    import json

    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer, pre_tokenizers
    slow = lru_cache(maxsize=1)(lambda: Tokenizer.from_file(path))  # loaded when a text needs it

    def exact(text: str) -> np.ndarray:
        return np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec["added_tokens"]]
    split, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return exact
    # The alphabet of a byte-level file: printable bytes stand for themselves, the others
    # for the code points from 256 on, in order.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    assert set(byte) == set(pre_tokenizers.ByteLevel.alphabet())
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        plain = text.isascii() or np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).max() < PLAIN_BELOW
        if not plain or any(s in text for s in special):
            return exact(text)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def cut(ids: np.ndarray, size: int = SIZE) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of a document's ids."""
    data = ids.astype("<u4")
    return [(s, len(data[s:s + size]), zlib.crc32(data[s:s + size].tobytes())) for s in range(0, len(data), size)]


@dataclass(frozen=True)
class Place:
    """Pieces ``rank`` to ``rank + count - 1`` of a length go to sequences ``sequence`` on, at ``offset``."""
    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def pack_histogram(histogram: dict[int, int], size: int = SIZE) -> list[Place]:
    """Places for all pieces of a length histogram, longest lengths first, shortest pack first."""
    packs: list[tuple[int, int, int]] = []  # (filled, first sequence, how many), one for each pattern
    out, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if not packs or packs[0][0] + length > size:  # none has room: open as few as can take the rest
                fresh = -(-left // (size // length))
                heapq.heappush(packs, (0, sequences, fresh))
                sequences += fresh
            filled, first, count = heapq.heappop(packs)
            n = min(count, left)
            out.append(Place(length, rank, n, first, filled))
            if n < count:
                heapq.heappush(packs, (filled, first + n, count - n))
            if filled + length < size:
                heapq.heappush(packs, (filled + length, first, n))
            rank, left = rank + n, left - n
    return out


def pieces_of(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, doc_key, start, length, ids_crc32, doc_tokens."""
    @F.arrow_udf("struct<n: long, piece: array<struct<start: long, length: long, ids_crc32: long>>>")
    def cut_up(text: pa.Array) -> pa.Array:
        encode = load_encoder(tokenizer_path)
        total, ends, start, length, crc = [], [0], [], [], []
        for t in text:
            ids = np.append(encode(t.as_py() or ""), np.uint32(end_id))
            for s, n, c in cut(ids, size):
                start.append(s)
                length.append(n)
                crc.append(c)
            total.append(len(ids))
            ends.append(len(start))
        one = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, crc)], ["start", "length", "ids_crc32"])
        return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), one)], ["n", "piece"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("doc_key"),
                        cut_up(F.col("text").cast("string")).alias("cut"))
            .select("doc_id", "doc_key", F.col("cut.n").alias("doc_tokens"), F.explode("cut.piece").alias("piece"))
            .select("doc_id", "doc_key", "piece.*", "doc_tokens"))


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID, rank_rows: int = 500_000) -> DataFrame:
    """All of ``docs`` packed: one row for each piece, with doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset (both from 0 without gaps).

    Null text counts as empty, so every row has at least the end id.  Rows
    with equal doc_id and text are interchangeable.  Columns besides doc_id
    and text are left out.  ``tokenizer_path`` must be readable on every
    executor.

    Ranks within a length come from counts by (length, salt), so a length
    that many documents share is ranked by several tasks of about
    ``rank_rows`` pieces each.
    """
    pieces = materialize(pieces_of(docs, tokenizer_path, size, end_id), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # One row for each place, sorted by length and rank: their number is bounded by the histogram's.
    places = sorted(pack_histogram(histogram, size), key=lambda p: (p.length, p.rank))
    length, rank, count, sequence, offset = (np.array([getattr(p, k) for p in places], np.int64) for k in ("length", "rank", "count", "sequence", "offset"))
    base = np.concatenate([[0], np.cumsum(count)])  # places before, over all lengths
    first = {n: int(base[i]) for i, n in reversed(list(enumerate(length.tolist())))}

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for n, r in batches:
            at = n.map(first).to_numpy(np.int64) + r.to_numpy(np.int64)
            i = np.searchsorted(base, at, side="right") - 1
            yield pd.DataFrame({"sequence_id": sequence[i] + at - base[i], "offset": offset[i]})

    salts = max(32, sum(histogram.values()) // rank_rows)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_key", "start", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
               .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "doc_key", "start")
    return (salted.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["length", "salt"])
            .withColumn("place", placed("length", F.col("rank") + F.col("before")))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "place.sequence_id", "place.offset"))
