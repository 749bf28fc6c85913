"""Piece lookup for many words at once: hashes of all substrings against one table."""

from __future__ import annotations

import numpy as np

MULTIPLIER, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def hashed(symbols: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of symbols."""
    h = np.zeros(len(symbols), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(symbols.shape[1]):
            h = h * MULTIPLIER + symbols[:, i] + np.uint64(1)
    return h


class PieceTable:
    """Hash table from 64-bit piece hashes to row numbers; ``none`` where there is no piece."""

    def __init__(self, hashes: np.ndarray):
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces have one hash")
        self.none = len(hashes)
        bits = max(4, int(8 * len(hashes) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        for row, (h, at) in enumerate(zip(hashes, self._slots(hashes).tolist())):
            while self.rows[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.rows[at] = h, row

    def _slots(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((h * SPREAD) >> self.shift).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = self._slots(h)
        rows = self.rows[at]
        hit = self.keys[at] == h
        out = np.where(hit & (rows >= 0), rows, np.int32(self.none))
        left = np.nonzero(~hit & (rows >= 0))
        while len(left[0]):
            at = (at[left] + 1) & self.mask
            rows, hit = self.rows[at], self.keys[at] == h[left]
            out[left] = np.where(hit & (rows >= 0), rows, np.int32(self.none))
            more = ~hit & (rows >= 0)
            full = np.zeros(h.shape, np.int64)
            left = tuple(x[more] for x in left)
            full[left] = at[more]
            at = full
        return out

    def substrings(self, symbols: np.ndarray, longest: int) -> list[np.ndarray]:
        """At k - 1: [word, start] -> row of the piece of length k that starts there."""
        length, out = symbols.shape[1], []
        h = np.zeros(symbols.shape, np.uint64)
        one = symbols + np.uint64(1)
        with np.errstate(over="ignore"):
            for k in range(1, min(longest, length) + 1):
                h = h[:, : length - k + 1] * MULTIPLIER + one[:, k - 1 :]
                out.append(self.find(h))
        return out
