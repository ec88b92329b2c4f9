"""Words and word hashes of Arrow text columns, computed on the UTF-8 bytes with numpy.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z count as a-z.  Hashes are 64-bit:
equal words always have equal hashes, unequal ones differ but for a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything but ASCII letters and digits and bytes of other scripts.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return self.up[:n], self.down[:n]


_CACHE = _Powers()
#: The C library's own way to return freed memory, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """``(first row, bytes, offsets)`` for runs of rows of about ``limit`` bytes; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        stop = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        stop = min(max(stop, first + 1), len(column))
        low, high = offsets[first], offsets[stop]
        yield first, data[low:high], offsets[first:stop + 1] - low
        first = stop


def give_back() -> None:
    """Lets Arrow and the C library return the memory of batches that are done, which they would
    keep for later ones; a worker is reused by other operators and shares its executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def word_spans(data: np.ndarray, offsets: np.ndarray,
               between: np.ndarray = _SPACE) -> tuple[np.ndarray, ...]:
    """Start and end byte of every word, and the first word of each row (one entry more).

    ``between`` marks the bytes that part words.
    """
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~between[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # a word never runs over the end of its row
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    if len(cuts):
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, offsets)


def running_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any span of ``data`` follows, A-Z taken as a-z."""
    up, _ = _CACHE.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return total


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span, from ``running_hash``."""
    _, down = _CACHE.upto(len(total))
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word, A-Z taken as a-z."""
    return span_hashes(running_hash(data), starts, ends)


_PLACES = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                    0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def combine(parts: list[np.ndarray], kind: int = 0) -> np.ndarray:
    """One hash of several word hashes in order; ``kind`` keeps unlike sequences apart."""
    out = np.full(len(parts[0]), kind, np.uint64)
    for i, part in enumerate(parts):
        if i % 5 == 0:
            out = mix(out)
        out = out + (part + np.uint64(i)) * _PLACES[i % 5]
    return mix(out)


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple:
    """Hashes of all runs of ``size`` words inside a row, and each row's first run.

    A row with fewer words (but some) has its whole sequence as its only run.
    """
    counts = np.diff(firsts)
    full = counts >= size
    runs = np.where(full, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(begin[-1], np.uint64)
    if full.any():
        last = len(words) - size + 1
        every = combine([words[i:last + i] for i in range(size)], size)
        at = np.arange(begin[-1]) + np.repeat(firsts[:-1] - begin[:-1], runs)
        inside = np.repeat(full, runs)
        out[inside] = every[at[inside]]
    for row in np.flatnonzero((counts > 0) & ~full):
        own = words[firsts[row]:firsts[row + 1]]
        out[begin[row]] = combine([own[i:i + 1] for i in range(len(own))], len(own))[0]
    return out, begin
