"""Elias-Fano sequences in flat buffers, read in bulk."""

from __future__ import annotations

import numpy as np

_POP = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
#: Values encoded at a time; a multiple of 8, so that parts end on whole bytes.
PART = 1 << 16
#: Place of the n-th one in a byte (8 if there is none).
_SELECT = np.array([[([k for k in range(8) if b >> k & 1] + [8] * 8)[n] for n in range(8)] for b in range(256)], dtype=np.uint8)


class EliasFano:
    """A monotone sequence: low bits packed, high bits as unary gaps with a byte-wise
    rank and select directory. ``buffers()`` are flat arrays that can be mapped and read in place."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = _POP[high].astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = 8 * np.arange(len(high) + 1) - self.rank
        byte = np.arange(len(high), dtype=np.int32)
        self.one, self.zero = np.repeat(byte, ones), np.repeat(byte, 8 - ones)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low_bits = max(0, int(np.log2(max(top + 1, 1) / n))) if n else 0
        places = np.arange(low_bits, dtype=np.uint64)
        packed = [np.packbits((v[a:a + PART, None] >> places & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") for a in range(0, n, PART)]
        low = np.concatenate([*packed, np.zeros(9, dtype=np.uint8)])
        high_values = (v >> np.uint64(low_bits)).astype(np.int64)
        unary = np.zeros((int(high_values[-1]) if n else 0) + n + 1, dtype=np.uint8)
        unary[high_values + np.arange(n)] = 1
        return cls(n, low_bits, low, np.packbits(unary, bitorder="little"))

    def buffers(self) -> tuple[bytes, bytes]:
        return self.low.tobytes(), self.high.tobytes()

    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.int64)
        bit = i * self.low_bits
        words = np.ndarray((len(self.low) - 7,), dtype="<u8", buffer=self.low, strides=(1,))
        first = words[bit >> 3] >> (bit & 7).astype(np.uint64)
        return (first & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``: select the i-th one of the high bits."""
        i = np.asarray(i, dtype=np.int64)
        byte = self.one[i].astype(np.int64)
        bit = 8 * byte + _SELECT[self.high[byte], i - self.rank[byte]]
        return (bit - i) << self.low_bits | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value at or above each ``x`` (n if there is none): the run
        of ones of its high part, found by selecting zeros, is searched by halving."""
        x = np.asarray(x, dtype=np.int64)
        h = x >> self.low_bits
        lo, hi = self._ones_before_zero(h - 1), self._ones_before_zero(h)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            less = np.zeros(len(x), dtype=bool)
            less[open_] = self.access(mid[open_]) < x[open_]
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return lo

    def _ones_before_zero(self, h: np.ndarray) -> np.ndarray:
        """Ones before the h-th zero of the high bits (counted from 0; before the first for h < 0)."""
        want = np.clip(h, 0, None)
        total = int(self.zeros[-1])
        inside = want < total
        w = np.where(inside, want, 0)
        byte = self.zero[w].astype(np.int64)
        bit = 8 * byte + _SELECT[255 - self.high[byte], w - self.zeros[byte]]
        out = np.where(inside, bit - w, self.n)
        return np.where(h < 0, 0, np.minimum(out, self.n))
