"""Vectorised word handling on the raw UTF-8 buffer of an Arrow string column.

Words are maximal runs of bytes other than space and 0x09-0x0D; those separators are ASCII, so
byte positions and code-point positions cut the text at the same places. Word and word-window
hashes come from prefix sums of a polynomial modulo 2**64 (no per-word Python work)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BITS = 18
SLICE_BYTES = 1 << SLICE_BITS  # text bytes handled at once: temporaries stay near 25 MB whatever the batch holds

_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_BYTE_VALUES = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(z: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (multiply and shift rounds)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, log2n: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << log2n
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        a = np.full(n, b, dtype=np.uint64)
        a[0] = 1
        out.append(np.cumprod(a))
    return out[0], out[1]


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, max(SLICE_BITS + 1, int(n).bit_length()))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into row ranges of about ``limit`` text bytes: ``(row_from, row_to, bytes, offsets)``.
    A NULL text has no bytes."""
    col = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


class Words:
    """Words of consecutive texts: byte spans, owning text, and mixed 64-bit word hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        n = len(data)
        if lower:
            data = _LOWER[data]
        word = ~_IS_SEP[data]
        first = np.ones(n + 1, dtype=bool)  # a text or separator ends right before position i
        first[1:n] = ~word[:-1] if n else False
        first[offsets] = True
        self.start = np.flatnonzero(word & first[:n])
        last = np.ones(n + 1, dtype=bool)
        last[:n] = ~word
        last[offsets] = True
        self.end = np.flatnonzero(word & last[1:]) + 1
        power, inverse = _power_tables(_BASE, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * power[:n], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * inverse[self.start])
        self.first = np.searchsorted(self.start, offsets)  # word range of text i: first[i]:first[i + 1]
        self.count = np.diff(self.first)

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on, over all words (windows across texts included);
        entry i is valid when words i..i+k-1 belong to one text. Length: number of words - k + 1."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, dtype=np.uint64)
        power, inverse = _power_tables(_WORD_BASE, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.hash * power[:n], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * inverse[:n - k + 1] + np.uint64(k))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (doubling, log2(width) passes)."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out
