"""Prefix polynomial hashes and minimiser blocks over NumPy arrays of symbols.

A symbol is a byte or the number of a word, as ``uint64``. Hashes are
polynomials modulo 2**64; they select candidates and find common extensions,
and whoever relies on them compares digests or the symbols themselves.

A *window* is ``width`` consecutive symbols of one document. Its anchor is the
leftmost of its ``k``-grams with the least hash, so equal windows have equal
anchors at equal offsets. A *block* is a maximal run of windows with one
anchor: equal blocks hold equal windows, and a window can only be equal to
windows of blocks with an equal anchor.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
POSITION_BITS = 26


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)
    return series(BASE), series(pow(BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    return _powers(1 << max(16, (size - 1).bit_length()))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(32)
    return values


class PrefixHash:
    """Hash of any stretch of ``symbols`` in constant time."""

    def __init__(self, symbols: np.ndarray):
        up, self._down = powers(len(symbols) + 1)
        self._sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[:len(symbols)],
                  out=self._sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self._sums[stop] - self._sums[start]) * self._down[start]

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all stretches of ``k`` symbols, by start."""
        size = len(self._sums) - k
        return (self._sums[k:] - self._sums[:size]) * self._down[:size]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by start."""
    size = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    table = padded.reshape(rows, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:size], forward[width - 1:width - 1 + size])


class Blocks(NamedTuple):
    """One entry per block; positions are in the joined symbols."""

    document: np.ndarray  # index of the document
    start: np.ndarray     # first window
    windows: np.ndarray   # number of windows
    anchor: np.ndarray    # start of the anchor
    key: np.ndarray       # hash of the anchor


def find_blocks(hashes: PrefixHash, bounds: np.ndarray, width: int, k: int) -> Blocks:
    """Blocks of the documents ``bounds[i]:bounds[i + 1]`` of the joined symbols."""
    total = int(bounds[-1])
    lengths = np.diff(bounds)
    documents = np.flatnonzero(lengths >= width)
    if not len(documents):
        nothing = np.zeros(0, np.int64)
        return Blocks(nothing, nothing, nothing, nothing, nothing.astype(np.uint64))
    if total >= 1 << POSITION_BITS:
        raise ValueError("too many symbols at once: split the batch")
    grams = mix(hashes.grams(k))
    position = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = sliding_min((grams & ~low) | position, width - k + 1)
    anchors = (least & low).astype(np.int64)
    counts = lengths[documents] - width + 1
    # Windows of all documents that have one, in order.
    ends = np.cumsum(counts)
    owner = np.repeat(documents, counts)
    window = np.arange(ends[-1]) + np.repeat(bounds[documents] - (ends - counts), counts)
    anchor = anchors[window]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return Blocks(owner[first], window[first], np.diff(np.append(first, len(window))),
                  anchor[first], mix(grams[anchor[first]]))
