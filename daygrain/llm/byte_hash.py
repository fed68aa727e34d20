"""Hashes of words and substrings of many texts at once, over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once, so that a dozen arrays of numbers stay small; a longer text is handled alone.
AT_ONCE = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the SplitMix64 finalizer)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def salt(k: int, factor: int = 0xC2B2AE3D27D4EB4F) -> np.uint64:
    """A different number for each k."""
    return U64((k + 1) * factor % (1 << 64))


#: A random number for each byte value.
BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    steps = np.full(n, base, U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(n: int, base: int) -> np.ndarray:
    size = max(AT_ONCE, 1 << (n - 1).bit_length())
    if size > 4 * AT_ONCE:  # for one very long text; not kept
        return _powers.__wrapped__(n, base)
    return _powers(size, base)[:n]


def text_parts(column: pa.Array, at_once: int = AT_ONCE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column of texts into runs of rows of about ``at_once`` bytes.

    Gives first row, row after the last, their bytes, and the bounds of each row's text among them.
    A null counts as an empty text.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + at_once, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word: a run of bytes other than 0x20 and 0x09 - 0x0D, within one row."""
    n = len(data)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before = np.r_[False, inside[:-1]]
    after = np.r_[inside[1:], False]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    sums = np.zeros(n + 1, U64)
    np.cumsum(BYTES[data] * powers(n, _BASE), out=sums[1:])
    found = mix((sums[ends] - sums[starts]) * powers(n + 1, _INVERSE)[starts])
    return found, np.searchsorted(bounds, starts, "right") - 1


def shingles(word: np.ndarray, row: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of ``size`` words, sorted within each row, and the row of each.

    A row with fewer words has its whole sequence as its only one; a row without words has none.
    """
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    place = np.arange(len(word)) - first[row]
    short = count[row] < size
    last = np.where(short, 0, count[row] - size)
    at = np.flatnonzero(place <= last)
    total = np.zeros(len(at), U64)
    for k in range(size):
        spot = np.minimum(at + k, len(word) - 1)
        part = mix(word[spot] + salt(k, 0xA24BAED4963EE407)) if len(word) else total
        inside = (k < count[row[at]]) if len(word) else np.zeros(0, bool)
        total += np.where(inside, part, salt(k, 0x9FB21C651E98DF25))
    hashes, owner = mix(total), row[at]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]
