"""Operator 4: token counts without token ids.

A SentencePiece BPE model never merges across a position where no piece of
its vocabulary has the two neighbouring characters side by side.  With the
vocabulary checked for it, a text falls apart before every run of spaces and
around every line feed, and its token count is the sum over these pre-tokens.

Documents are taken in chunks.  A chunk sends out each of its distinct
pre-tokens once; equal pre-tokens of all chunks meet, and their pieces are
counted once.  The numbers go back to the chunks, where they are joined to the
documents' pre-token frequencies and summed.  Only numbers for a pre-token and
chunk move, never ones for a document and pre-token.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import without

OUT = ("n_bytes", "n_tokens", "over_limit")
SPACE = "▁"  # the model's sign for a space
PRE_TOKEN = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*")
CHUNK_DOCS, CHUNK_ENTRIES = 1 << 14, 1 << 21


def load_model(path: str):
    """The processor, after checking that pre-tokens are independent under its vocabulary."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if re.search(f"[^{SPACE}]{SPACE}", piece) or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses a pre-token boundary; count whole texts with this model")
    if model.encode("\n", out_type=str)[:1] != [SPACE] or model.encode("a  b ") == model.encode("a b"):
        raise ValueError("the model must add one space in front and keep all others")
    return model


def pre_tokens(text: str) -> list[str]:
    """A text's pre-tokens, with the space that the model puts in front."""
    return PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE)) if text else []


def count_pieces(model, tokens: list[str]) -> np.ndarray:
    """Tokens of each pre-token.

    Encoding puts one space in front: it stands for a pre-token's own first
    space, and is counted off again before a line feed.
    """
    texts = [t[1:] if t[0] == SPACE else t for t in tokens]
    ids = model.encode(texts, num_threads=1)
    return np.array([1 if t == SPACE else len(x) - (t[0] == "\n") for t, x in zip(tokens, ids)], np.int64)


_ROWS = pa.schema([("token", pa.string()), ("chunk", pa.int64()), ("at", pa.int64()), ("data", pa.binary())])


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as compressed bytes: their lengths, then each as int64, differences first."""
    lens = np.array([len(columns), *map(len, columns)], np.int64)
    body = b"".join(np.diff(c.astype(np.int64), prepend=0).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(lens.tobytes() + body)


def _unpacked(data: bytes) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64)
    ends = 1 + flat[0] + np.concatenate([[0], np.cumsum(flat[1:1 + flat[0]])])
    return [np.cumsum(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk: one for each distinct pre-token (token, its number in the chunk), and one
    without token, whose data is the documents' frequencies, ids and sizes."""
    from pyspark import TaskContext
    task = TaskContext.get()
    chunk = (task.partitionId() if task else 0) << 32
    names: dict[str, int] = {}
    at, n, distinct, ids, sizes = [], [], [], [], []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal chunk, names, at, n, distinct, ids, sizes
        words = list(names)
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(part, pa.string()), pa.array(np.full(len(part), chunk)), pa.array(np.arange(i, i + len(part))),
                pa.nulls(len(part), pa.binary())], schema=_ROWS)
        known = np.array([i is not None for i in ids])
        data = _packed(np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros(0, np.int64), *n]),
                       np.array(distinct, np.int64), known, np.array([i or 0 for i in ids], np.int64), np.array(sizes, np.int64))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([chunk]), pa.array([-1]), pa.array([data], pa.binary())], schema=_ROWS)
        chunk += 1
        names, at, n, distinct, ids, sizes = {}, [], [], [], [], []

    entries = 0
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_py() or ""
            count = Counter(pre_tokens(text))
            number = np.fromiter((names.setdefault(t, len(names)) for t in count), np.int64, len(count))
            order = np.argsort(number)
            at.append(number[order])
            n.append(np.fromiter(count.values(), np.int64, len(count))[order])
            distinct.append(len(count))
            ids.append(doc_id)
            sizes.append(len(text.encode()))
            entries += len(count)
            if entries >= CHUNK_ENTRIES or len(ids) >= CHUNK_DOCS:
                yield from flush()
                entries = 0
    if ids:
        yield from flush()


def _count_once(model_path: str, hold: int = 1 << 20):
    """Of rows sorted by token: each token's pieces, counted once, as rows (chunk, data) for the chunks that have it."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        last, last_pieces, held = None, 0, []

        def flush() -> pa.RecordBatch:
            chunk, at, pieces = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*held) if held else ((), (), ())))
            order = np.lexsort((at, chunk))
            chunk, at, pieces = chunk[order], at[order], pieces[order]
            start = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]) if len(chunk) else np.zeros(0, np.int64)
            data = [_packed(at[a:b], pieces[a:b]) for a, b in zip(start, np.r_[start[1:], len(chunk)])]
            return pa.RecordBatch.from_arrays([pa.array(chunk[start]), pa.array(data, pa.binary()), pa.array([False] * len(data), pa.bool_())],
                                              names=["chunk", "data", "documents"])

        for b in batches:
            is_token = np.asarray(b.column(0).is_valid())
            if not is_token.all():  # the documents' rows pass through
                rest = b.filter(pa.array(~is_token))
                yield pa.RecordBatch.from_arrays([rest.column(1), rest.column(3), pa.array([True] * len(rest), pa.bool_())],
                                                 names=["chunk", "data", "documents"])
                b = b.filter(pa.array(is_token))
            if not len(b):
                continue
            runs = b.column(0).dictionary_encode()
            names = runs.dictionary.to_pylist()
            todo = [t for t in names if t != last]
            known = dict(zip(todo, count_pieces(model, todo) if todo else [])) | ({last: last_pieces} if last is not None else {})
            last = b.column(0)[len(b) - 1].as_py()
            last_pieces = known[last]
            held.append((b.column(1).to_numpy(), b.column(2).to_numpy(), np.array([known[t] for t in names], np.int64)[runs.indices.to_numpy()]))
            if sum(len(h[0]) for h in held) >= hold:
                yield flush()
                held = []
        if held:
            yield flush()

    return counted


def _sums(rows: pa.Table) -> pa.Table:
    """A chunk's documents with their sums of frequency times pieces."""
    pieces, documents = [], None
    for data, is_documents in zip(rows.column("data").to_pylist(), rows.column("documents").to_pylist()):
        if is_documents:
            documents = _unpacked(data)
        else:
            pieces.append(_unpacked(data))
    at, n, distinct, known, ids, sizes = documents
    size = np.zeros(1 + max([int(a.max()) for a, _ in pieces if len(a)], default=0), np.int64)
    for a, p in pieces:
        size[a] = p
    total = np.concatenate([[0], np.cumsum(size[at] * n)])
    end = np.cumsum(distinct)
    return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=known == 0), "n_bytes": sizes, "n_tokens": total[end] - total[end - distinct]})


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """For every row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Counts are those of the model's own encoding of the whole text without
    begin and end tokens; null text counts as empty.  Repeated rows and null
    doc_ids are counted row by row.  ``model_path`` must be readable on every
    executor.  Columns besides doc_id and text are left out.

    Chunks of at most 16,384 documents bound a task's memory; a very common
    pre-token has one row for each chunk.  A chunk's frequencies travel
    through the same shuffle as its pre-tokens, so both come from the same
    attempt of the same task.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _frequencies, "token string, chunk long, at long, data binary")
    # Equal tokens meet; the documents' rows, without token, are spread by chunk.
    met = rows.repartition("token", F.when(F.col("token").isNull(), F.col("chunk"))).sortWithinPartitions("token")
    counted = met.mapInArrow(_count_once(model_path), "chunk long, data binary, documents boolean")
    sums = counted.groupBy("chunk").applyInArrow(_sums, "doc_id long, n_bytes long, n_tokens long")
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
