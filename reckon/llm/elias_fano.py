"""Elias-Fano sequences in memory-mapped files."""

from __future__ import annotations

import tempfile

import numpy as np


def mapped(data: bytes) -> np.ndarray:
    """The bytes in an unlinked file of the task's own, mapped into memory."""
    f = tempfile.TemporaryFile()
    f.write(data or b"\0")
    f.flush()
    return np.memmap(f, np.uint8, "r")


class EliasFano:
    """A sorted sequence below ``universe``: high parts in unary, low parts in l bits each."""

    def __init__(self, values: np.ndarray, universe: int):
        values = values.astype(np.uint64)
        self.n = n = len(values)
        self.l = l = max(0, min(56, (int(universe) // max(1, n)).bit_length() - 1))
        high = (values >> np.uint64(l)).astype(np.int64)
        bits = np.zeros(n + (int(universe - 1) >> l) + 2, np.uint8)
        bits[high + np.arange(n)] = 1  # a one for each value, a zero after each high part
        ones = np.packbits(bits, bitorder="little").tobytes()
        ones += b"\xff" * (-len(ones) % 8)
        low = b""
        if l:
            for k in range(0, n, 1 << 16):
                part = values[k : k + (1 << 16), None] >> np.arange(l, dtype=np.uint64) & np.uint64(1)
                low += np.packbits(part.astype(np.uint8).ravel(), bitorder="little").tobytes()  # 65536 l bits are whole bytes
        self.high = mapped(ones).view("<u8")
        low = mapped(low + b"\0" * 16)
        self.low = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))
        bits = np.unpackbits(self.high.view(np.uint8), bitorder="little")
        self.zeros, self.ones = np.flatnonzero(bits == 0), np.flatnonzero(bits)[:n]  # select directories, while in use

    @property
    def n_bytes(self) -> int:
        return self.high.nbytes + len(self.low)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.uint64)
        bit = i * self.l
        return (self.low[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.l) - 1)

    def below(self, high: np.ndarray) -> np.ndarray:
        """How many values have a smaller high part: the place of the zero that ends the one before."""
        return np.where(high > 0, self.zeros[np.minimum(high, len(self.zeros)) - 1] + 1 - high, 0)

    def next_geq(self, x: np.ndarray) -> np.ndarray:
        """Places of the first values not below x (n if none): binary search among equal high parts."""
        x = x.astype(np.uint64)
        high, low = (x >> np.uint64(self.l)).astype(np.int64), x & np.uint64((1 << self.l) - 1)
        lo, hi = self.below(high), self.below(high + 1)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = np.zeros(len(x), bool)
            less[open_] = self.lows(mid[open_]) < low[open_]
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return lo

    def find(self, x: np.ndarray) -> np.ndarray:
        """Places of values equal to x, -1 where there is none."""
        at = self.next_geq(x)
        high = (x.astype(np.uint64) >> np.uint64(self.l)).astype(np.int64)
        same = at < self.below(high + 1)
        same[same] = self.lows(at[same]) == x[same].astype(np.uint64) & np.uint64((1 << self.l) - 1)
        return np.where(same, at, -1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places i."""
        return ((self.ones[i] - i).astype(np.uint64) << np.uint64(self.l)) | self.lows(i)
