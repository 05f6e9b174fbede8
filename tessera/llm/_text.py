"""Words of Arrow text columns as numpy arrays.

Everything works on the column's UTF-8 buffer: word borders from one lookup
per byte, a 64-bit polynomial hash of every word from one prefix sum. No
Python object is made per word. Batches are cut into slices of whole texts
of about ``SLICE`` bytes, so memory follows the slice (or the longest text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2 << 20  # bytes of text handled at once (a longer text stands alone)

U = np.uint64
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (kept per worker)."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE + 1)
        up = np.full(size, U(BASE)); up[0] = 1
        down = np.full(size, U(BASE_INV)); down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into the bytes) of runs of whole texts;
    a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    if n == 0:
        return
    _, off, data = texts.buffers()
    off = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield first, data[off[first]:off[last]], off[first:last + 1] - off[first]
        first = last


class Words:
    """Words of a slice: ``start``/``end`` byte positions, ``row`` of each
    word, ``first`` word of each row (length rows + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = ~IS_SPACE[data]
        head = np.empty(n, dtype=bool)
        if n:
            head[0] = True
            np.logical_not(inside[:-1], out=head[1:])
            cut = offsets[1:-1]
            head[cut[cut < n]] = True
            head &= inside
            tail = np.empty(n, dtype=bool)
            tail[-1] = True
            np.logical_not(inside[1:], out=tail[:-1])
            tail[cut[cut > 0] - 1] = True
            tail &= inside
            self.start = np.flatnonzero(head)
            self.end = np.flatnonzero(tail) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, offsets, side="left")
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """64-bit hash of each word (A-Z lower-cased first)."""
        return span_hashes(LOWER[self.data] if lower else self.data, self.start, self.end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    up, down = powers(n + 1)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(BYTE_CODE[data] * up[:n], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def chars(data: np.ndarray) -> np.ndarray:
    """1 where a byte starts a UTF-8 character."""
    return (data & 0xC0) != 0x80


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of k consecutive word hashes."""
    n = len(h) - k + 1
    s = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(k):
        s = mix(s * U(0xC2B2AE3D27D4EB4F) + h[j:j + n])
    return s


def row_sets(words: Words, hashes: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct shingles of k words; fewer words count as
    one shingle, none give an empty set."""
    all_shingles = shingle_hashes(hashes, k)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = b - a
        if n >= k:
            yield np.unique(all_shingles[a:b - k + 1])
        elif n:
            yield shingle_hashes(hashes[a:b], n) ^ U(0xA5A5A5A5A5A5A5A5 + n)
        else:
            yield np.zeros(0, dtype=np.uint64)


def gather(table: np.ndarray, offset: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated entries ``ids`` of a byte table: entry i is
    ``table[offset[i]:offset[i+1]]``. Returns bytes and the running ends."""
    size = (offset[1:] - offset[:-1])[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    shift = offset[ids] - (ends - size)
    return table[np.repeat(shift, size) + np.arange(total)], ends
