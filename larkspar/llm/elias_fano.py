"""Elias-Fano coding of monotone sequences: packed low bits, unary high bits with rank samples and select.

A sequence is one run of bytes and is queried in place, in a buffer or a mapped file, without being expanded.
"""

from __future__ import annotations

import struct

import numpy as np

_U = np.uint64
_HEAD = "<QQQQQQ"  # values, low bits, greatest high part, bytes of low bits, high bits and samples
BLOCK = 16  # bytes of high bits between two samples
LOT = 1 << 16  # queries worked at a time
#: Place of the k-th set bit of a byte, lowest first.
_PLACE = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    _set = [b for b in range(8) if _byte >> b & 1]
    _PLACE[_byte, : len(_set)] = _set


def encode(values: np.ndarray) -> bytes:
    """values: non-decreasing."""
    values = values.astype(_U)
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = min(56, max(0, ((top + 1) // n).bit_length() - 1)) if n else 0
    lots = []
    for i in range(0, n if low_bits else 0, LOT):
        bits = (values[i : i + LOT, None] >> np.arange(low_bits, dtype=_U)[None, :] & _U(1)).astype(np.uint8)
        lots.append(np.packbits(bits.ravel(), bitorder="little"))
    low = np.concatenate([*lots, np.zeros(8, np.uint8)])
    high = (values >> _U(low_bits)).astype(np.int64)
    last = int(high[-1]) if n else 0
    unary = np.zeros(-(-(n + last + 2) // (8 * BLOCK)) * 8 * BLOCK, bool)
    unary[high + np.arange(n)] = True
    packed = np.packbits(unary, bitorder="little")
    ones = np.bitwise_count(packed).reshape(-1, BLOCK).sum(1, dtype=np.int64)
    samples = (np.cumsum(ones) - ones).astype(np.uint32)
    if n >= 1 << 32:
        raise ValueError("too long for 32-bit samples")
    pad = b"\0" * (-len(low) % 8)
    head = struct.pack(_HEAD, n, low_bits, last, len(low) + len(pad), len(packed), samples.nbytes)
    return head + low.tobytes() + pad + packed.tobytes() + samples.tobytes()


class Sequence:
    """A view of an encoded sequence; `end` is where it stops in the buffer."""

    def __init__(self, buffer, at: int = 0):
        self.n, self.low_bits, self.last, low, high, samples = struct.unpack_from(_HEAD, buffer, at)
        at += struct.calcsize(_HEAD)
        self.low = np.frombuffer(buffer, np.uint8, low, at)
        self.high = np.frombuffer(buffer, np.uint8, high, at + low)
        self.ones = np.frombuffer(buffer, np.uint32, samples // 4, at + low + high)
        self.end = at + low + high + samples

    def _lots(self, f, x: np.ndarray) -> np.ndarray:
        return np.concatenate([f(x[i : i + LOT]) for i in range(0, len(x), LOT)]) if len(x) else np.zeros(0, np.int64)

    def select(self, k: np.ndarray, bit: bool) -> np.ndarray:
        """Place of the k-th (from 0) such bit of the high part."""
        before = self.ones.astype(np.int64)
        before = before if bit else np.arange(len(before)) * 8 * BLOCK - before

        def lot(k):
            block = np.searchsorted(before, k, "right") - 1
            held = self.high[block[:, None] * BLOCK + np.arange(BLOCK)]
            held = held if bit else ~held
            seen = np.cumsum(np.bitwise_count(held), axis=1, dtype=np.uint8)  # 128 at most
            rest = k - before[block]
            byte = (seen <= rest[:, None]).sum(1)
            row = np.arange(len(k))
            rest -= np.where(byte > 0, seen[row, np.maximum(byte - 1, 0)], 0)
            return block * 8 * BLOCK + byte * 8 + _PLACE[held[row, byte], rest]

        return self._lots(lot, k)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)

        def lot(i):
            bit = i * self.low_bits
            window = np.ascontiguousarray(self.low[(bit >> 3)[:, None] + np.arange(8)]).view(_U)[:, 0]
            return window >> (bit & 7).astype(_U) & _U((1 << self.low_bits) - 1)

        return self._lots(lot, i).astype(_U)

    def access(self, i: np.ndarray) -> np.ndarray:
        return (self.select(i, True) - i).astype(_U) << _U(self.low_bits) | self.lows(i)

    def successor(self, x: np.ndarray, a: np.ndarray | None = None, b: np.ndarray | None = None) -> np.ndarray:
        """First place in [a, b) whose value is x or more, among those that share x's high part; -1 if it is not x itself."""
        out = np.full(len(x), -1, np.int64)
        high = (x >> _U(self.low_bits)).astype(np.int64)
        live = np.flatnonzero(high <= self.last) if self.n else np.zeros(0, np.int64)
        h = high[live]
        low = np.where(h > 0, self.select(np.maximum(h - 1, 0), False) - (h - 1), 0)
        end = self.select(h, False) - h
        if a is not None:
            low, end = np.maximum(low, a[live]), np.minimum(end, b[live])
        want = x[live] & _U((1 << self.low_bits) - 1)
        stop = end.copy()
        open_ = np.flatnonzero(low < stop)
        while len(open_):
            middle = (low[open_] + stop[open_]) >> 1
            less = self.lows(middle) < want[open_]
            low[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < stop[open_]]
        inside = np.flatnonzero(low < end)
        hit = inside[self.lows(low[inside]) == want[inside]]
        out[live[hit]] = low[hit]
        return out
