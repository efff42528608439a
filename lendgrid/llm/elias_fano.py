"""Elias-Fano code of an ascending sequence, with select.

A sequence of ``n`` numbers up to ``u`` is split into ``low`` bits per number,
packed side by side, and a bit vector of the high parts in unary: number ``i``
sets bit ``high(i) + i``. That is at most ``2 + log2(u / n)`` bits a number.
``select(i)`` is the place of the i-th set bit, found from a sample of every
512th set bit and a count of bits from there.
"""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<QQBQQQ")  # numbers, largest, low bits, bytes of low, of high, of samples
EVERY = 512
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)


def encode(values) -> bytes:
    """``values``: ascending (repeats allowed), not negative."""
    values = np.asarray(values, dtype=np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low_bits = max(0, (top // n).bit_length() - 1) if n else 0
    lows = values & np.uint64((1 << low_bits) - 1)
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = np.packbits(((lows[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") if low_bits else np.zeros(0, np.uint8)
    places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
    bits = np.zeros((int(places[-1]) + 1) if n else 0, np.uint8)
    bits[places] = 1
    high = np.packbits(bits, bitorder="little")
    samples = places[::EVERY].astype("<u8" if n and places[-1] >> 32 else "<u4")
    return HEADER.pack(n, top, low_bits, len(low), len(high), samples.nbytes) + low.tobytes() + high.tobytes() + samples.tobytes()


class EliasFano:
    """Reads numbers from the bytes of :func:`encode`; ``size`` is their length."""

    def __init__(self, data, at: int = 0):
        self.n, self.top, self.low_bits, n_low, n_high, n_samples = HEADER.unpack_from(data, at)
        at += HEADER.size
        self.low = np.frombuffer(data, np.uint8, n_low, at)
        self.high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        wide = 8 if n_samples // max(1, -(-self.n // EVERY)) == 8 else 4
        self.samples = np.frombuffer(data, f"<u{wide}", n_samples // wide, at + n_low + n_high)
        self.size = HEADER.size + n_low + n_high + n_samples

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Place of the i-th set bit of the high vector."""
        at, left = int(self.samples[i // EVERY]), i % EVERY
        byte, keep = at >> 3, 0xFF & ~((1 << (at & 7)) - 1)
        left += 1
        while True:
            ones = int(_ONES[int(self.high[byte]) & keep])
            if left <= ones:
                break
            left, byte, keep = left - ones, byte + 1, 0xFF
        bits = int(self.high[byte]) & keep
        for _ in range(left - 1):
            bits &= bits - 1
        return (byte << 3) + (bits & -bits).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        low = 0
        if self.low_bits:
            first = i * self.low_bits
            a, b = first >> 3, (first + self.low_bits + 7) >> 3
            low = (int.from_bytes(self.low[a:b].tobytes(), "little") >> (first & 7)) & ((1 << self.low_bits) - 1)
        return ((self.select(i) - i) << self.low_bits) | low

    def all(self) -> np.ndarray:
        """All numbers at once: every set bit of the high vector, and its low part."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (places - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            out |= bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return out
