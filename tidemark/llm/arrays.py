"""Texts of an Arrow batch as one byte array, and hashes over it."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_U = np.uint64


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text boundaries; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def groups(offsets: np.ndarray, most: int):
    """Runs of texts (first, last + 1) of at most ``most`` bytes together, or one longer text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@functools.cache
def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 64, 256, _U, endpoint=False)


_POWERS: dict[int, np.ndarray] = {}
#: Longer tables are made for one text and given back.
KEPT = 1 << 19


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = n if n > KEPT else max(1024, 1 << (n - 1).bit_length())
        have = np.full(size, base, _U)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= KEPT:
            _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit; one to one."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each text boundary."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opened, closed = inside.copy(), inside.copy()
    opened[1:] &= ~inside[:-1] | edge[1:-1]
    closed[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(opened)
    return starts, np.flatnonzero(closed) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """One 64-bit hash per word; equal words have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, _U)
    sums, back = window_hashes(data, seed)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(_U))


def run_hashes(h: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n`` words that start at each word, inside one text, and those words' indices.

    ``bounds``: number of words before each text boundary.
    """
    counts = np.maximum(np.diff(bounds) - (n - 1), 0)
    heads = np.cumsum(counts) - counts
    at = np.arange(int(counts.sum())) - np.repeat(heads, counts) + np.repeat(bounds[:-1], counts)
    out = np.zeros(len(at), _U)
    for j in range(n):
        out = out * _U(BASE) + h[at + j]
    return mix(out), at


def window_hashes(data: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums S and inverse powers Q: (S[i+n] - S[i]) * Q[i] identifies data[i:i+n]."""
    n = len(data)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_table(seed)[data] * powers(BASE, n), out=sums[1:])
    return sums, powers(INVERSE, n + 1)


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, .. for each of the ranges, one after the other."""
    heads = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - heads, lengths)
