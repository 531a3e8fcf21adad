"""Numpy scans over UTF-8 buffers: hashes, words, sliding minima, record packing.

Everything works on one flat ``uint8`` buffer that holds many texts, so the
cost per byte is a few vector passes and no Python loop over characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that one chunk holds (working arrays take about 60 times that).
CHUNK_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 22
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: ASCII white space: blank and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Lower-cases A to Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _ODD
    return h ^ (h >> np.uint64(32))


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xA0761D6478BD642F
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 2 ** 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64, for 0..n-1 at least."""
    size = 1 << max(20, int(n).bit_length())
    return _powers(size)


class Spans:
    """Hashes of any spans of a sequence of 64-bit codes in constant time each."""

    def __init__(self, codes: np.ndarray):
        self.up, self.down = powers(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.up[:len(codes)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def every(self, width: int) -> np.ndarray:
        """The hash of each run of ``width`` codes."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:-width]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def byte_spans(buf: np.ndarray) -> Spans:
    return Spans(_CODE[buf])


def slice_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each slice, for slices in order of place, in pieces that bound working memory."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right")))
        lo = starts[i]
        out[i:j] = byte_spans(buf[lo:ends[j - 1]])(starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return out


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary Arrow array as (buffer, offsets), without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def groups_of_rows(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes other than ASCII white space."""
    edge = np.diff(np.concatenate(([True], _SPACE[buf], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def gathered(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return buf[np.arange(total) + np.repeat(starts - before, lengths)]


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys, by doubling."""
    if len(keys) < width:
        return keys[:0]
    best, span = keys, 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    return best if span == width else np.minimum(best[:len(keys) - width + 1], best[width - span:])


def minimiser_runs(hashes: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (first window, last window, seed hash) of windows with one minimiser.

    A window is ``width`` consecutive hashes; its minimiser is the smallest
    (upper 42 bits compared), the leftmost of equal ones. ``valid`` marks the
    windows that exist. Windows of equal content get equal seeds at equal
    offsets, wherever they stand.
    """
    assert len(hashes) < 1 << _PLACE_BITS, "chunks are cut shorter"
    if not len(valid) or not valid.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    bits = np.uint64(_PLACE_BITS)
    keys = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(keys, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = valid.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= new[1:] | ~valid[1:]
    return first, np.flatnonzero(stop), hashes[at[first]]


def same_slices(buf: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the slices of ``lengths`` bytes at ``a`` and at ``b`` are equal, byte by byte."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    same = np.ones(len(a), bool)
    open_ = np.arange(len(a))
    at = 0
    while len(open_):
        left = lengths[open_] - at
        whole = left >= 8
        x = np.ascontiguousarray(words[a[open_] + at]).view(">u8").ravel()
        y = np.ascontiguousarray(words[b[open_] + at]).view(">u8").ravel()
        cut = np.where(whole, 0, 8 * (8 - np.clip(left, 1, 8))).astype(np.uint64)
        equal = (x >> cut) == (y >> cut)
        same[open_[~equal]] = False
        open_ = open_[equal & (left > 8)]
        at += 8
    return same
