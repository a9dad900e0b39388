"""A wavelet matrix over small symbols (numpy, inside Spark tasks): rank and bisection on ranks.

Symbols of a few bits are stored one bit plane a level, from the highest bit down; after each
level the symbols with a 0 there move, in order, before those with a 1. A rank query follows a
symbol through the levels with two bit counts each, so its cost does not depend on the length.
All queries take arrays of positions.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class BitPlane:
    """Bits with a running count a 64-bit word: ``ones(i)`` counts the ones before ``i``."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words)
        self.before = np.cumsum(counts, dtype=np.int64) - counts
        self.zeros = len(bits) - int(counts.sum(dtype=np.int64))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, bits: int):
        self.size = len(symbols)
        self.planes: list[tuple[int, BitPlane]] = []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.planes.append((level, BitPlane(bit)))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each position."""
        start, end = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for level, plane in self.planes:
            if symbol >> level & 1:
                start, end = plane.zeros + plane.ones(start), plane.zeros + plane.ones(end)
            else:
                start, end = start - plane.ones(start), end - plane.ones(end)
        return end - start

    def count(self, symbols, at: np.ndarray) -> np.ndarray:
        """Occurrences of any of several symbols before each position."""
        return sum((self.rank(s, at) for s in symbols), np.zeros(len(at), np.int64))

    def last_with(self, symbols, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest position in ``[low, high]`` before which at most ``most`` of the symbols
        occur, by bisection on the ranks (which never fall)."""
        low, high = low.astype(np.int64), high.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.count(symbols, middle) <= most
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low
