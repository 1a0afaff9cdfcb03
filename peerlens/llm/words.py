"""Words of whole texts as flat numpy arrays, straight from Arrow buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D.  UTF-8 keeps
these bytes for themselves, so cutting bytes and cutting characters agree.
Texts are worked on in blocks of some hundred kilobytes, a longer text alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
U64 = np.uint64


def release() -> None:
    """Give freed memory back: workers live on after a task, beside those of the next one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A group function that gives its memory back after each group."""

    def run(table: pa.Table) -> pa.Table:
        out = function(table)
        del table
        release()
        return out

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler: equal in, equal out, neighbours far apart."""
    h = np.array(h, dtype=U64)
    h ^= h >> U64(31)
    h *= U64(0x9E6C63D0876A9A47)
    h ^= h >> U64(29)
    h *= U64(0xD1B54A32D192ED03)
    h ^= h >> U64(32)
    return h


def _lower_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = _lower_bytes()
IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))
BASE = 0xA0761D6478BD642F | 1


class Powers:
    """Powers of the base and of its inverse modulo 2^64; each process makes its own."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def __reduce__(self) -> tuple:
        return Powers, ()

    def least(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (self._series(b, max(n, BLOCK_BYTES)) for b in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up, self.down

    @staticmethod
    def _series(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, U64)
        steps[0] = 1
        return np.cumprod(steps, dtype=U64)


POWERS = Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse modulo 2^64."""
    return POWERS.least(n)


class Texts:
    """Some consecutive texts of a batch, cut into words.

    ``data`` are their bytes, ``bounds`` where each text starts and the last
    ends, ``starts``/``ends`` the words' bytes and ``first`` the first word of
    each text (one entry more than texts).
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, row: int, lower: bool = True):
        self.row, self.bounds = row, bounds
        self.rows = len(bounds) - 1
        self.raw = data
        self.data = LOWER[data] if lower else data
        inside = ~IS_SPACE[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = bounds[:-1][np.diff(bounds) > 0]
        opens[edges] = inside[edges]
        lasts = bounds[1:][np.diff(bounds) > 0] - 1
        closes[lasts] = inside[lasts]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts())

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each span; equal bytes, equal hash."""
        up, down = powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum(BYTE_VALUE[self.data] * up[: len(self.data)], dtype=U64, out=sums[1:])
        h = (sums[ends] - sums[starts]) * down[starts]
        return mix(h + (ends - starts).astype(U64))

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)


def texts_of(column: pa.Array, lower: bool = True, block_bytes: int = BLOCK_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow string column, block by block; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if not rows:
        return
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + block_bytes, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield Texts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], low, lower)
        low = high
    release()


def windows(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside one text, and the text of each.

    A text with fewer words has its whole sequence as one window, a text
    without words none.
    """
    counts = np.diff(first)
    total = len(words)
    factors = mix(np.arange(1, size + 1, dtype=U64)) | U64(1)
    summed = np.zeros(total, U64)
    for j in range(min(size, total)):
        summed[: total - j] += words[j:] * factors[j]
    text = np.repeat(np.arange(len(counts)), counts)
    full = np.arange(total) + size <= np.repeat(first[1:], counts)
    out, owner = mix(summed[full]), text[full]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        part = np.zeros(len(short), U64)
        for j in range(size - 1):
            has = counts[short] > j
            part[has] += words[first[short[has]] + j] * factors[j]
        part = mix(part + counts[short].astype(U64) * factors[size - 1] + U64(1))
        out, owner = np.concatenate([out, part]), np.concatenate([owner, short])
    return out, owner


def distinct_windows(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of windows of each text: hashes, sorted by text and hash, and the first of each text."""
    h, owner = windows(texts.word_hash(), texts.first, size)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.searchsorted(owner, np.arange(texts.rows + 1))


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive entries of ``first`` (empty: 0), wrapping."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
