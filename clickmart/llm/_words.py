"""Vectorised word splitting and hashing over the UTF-8 buffer of an Arrow column.

A word is a run of bytes of a word class.  Its hash is a polynomial in
per-byte random 64-bit values, taken from one prefix sum modulo 2**64, then
mixed; equal words have equal hashes, and different ones collide with
probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = []

#: Words of the `[^\x20\x09-\x0D]+` class: everything but ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` on text with A-Z lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Maps A-Z to a-z and keeps all other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 19)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.multiply.accumulate(np.full(n, b, np.uint64)) for b in (_BASE, _BASE_INV)]
    return _POWERS[0], _POWERS[1]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, null as empty, and the n + 1 offsets of the values.  Copies no text unless there are nulls."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    if ends is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents of about ``limit`` bytes; a longer document is one by itself."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(buf: np.ndarray, bounds: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of the words, and the first word of each document.

    ``bounds``: n + 1 document offsets into ``buf``; the result's last entry is
    the number of words.  A word never crosses a document boundary.
    """
    is_word = word[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = is_word[:-1]
    first = bounds[:-1][bounds[:-1] < len(buf)]
    before[first] = False
    after = np.zeros(len(buf), bool)
    after[:-1] = is_word[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    return starts, np.flatnonzero(is_word & ~after) + 1, np.searchsorted(starts, bounds)


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """64-bit hash of each byte range, in runs of ranges that span about ``step`` bytes, which bounds the working memory."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + step)))
        low, a, b = starts[i], starts[i:j] - starts[i], ends[i:j] - starts[i]
        n = int(b[-1])
        up, down = _powers(n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[buf[low:low + n]] * up[:n], out=total[1:])
            out[i:j] = mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes (n - 1 fewer values); order matters."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        # Doubling: a run of 2m words is (first m) * base**m + (last m).
        out, have, base = None, 0, _BASE
        power, size, factor = h, 1, base
        rest = n
        while rest:
            if rest & 1:
                if out is None:
                    out, have = power, size
                else:  # the run so far, followed by a run of `size` words
                    m = len(h) - have - size + 1
                    out = out[:m] * U(factor) + power[have:have + m]
                    have += size
            rest >>= 1
            if rest:
                m = len(h) - 2 * size + 1
                power = power[:m] * U(factor) + power[size:size + m]
                factor, size = factor * factor % (1 << 64), size * 2
        return mix(out[:len(h) - n + 1].copy())
