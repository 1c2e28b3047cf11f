"""Elias-Fano sequences: sorted numbers in about two bits more than the logarithm of their mean gap, with search."""
from __future__ import annotations

import numpy as np

EVERY = 64  # bits of one kind between directory entries


_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Place of the n-th set bit in a byte: by n and byte.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[n] for n in range(8) for byte in range(256)], np.int64)


def _nth(bits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th set bit (from 0) of 64: counts of the bytes, summed up in one multiplication, tell its byte."""
    counts = bits - (bits >> np.uint64(1) & np.uint64(0x5555555555555555))
    counts = (counts & np.uint64(0x3333333333333333)) + (counts >> np.uint64(2) & np.uint64(0x3333333333333333))
    counts = (counts + (counts >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _ONES
    place = np.bitwise_count((n * _ONES | _TOPS) - counts & _TOPS).astype(np.uint64) * np.uint64(8)
    before = np.where(place > 0, counts >> (place - np.uint64(8) * (place > 0).astype(np.uint64)) & np.uint64(0xFF), np.uint64(0))
    return place.astype(np.int64) + _IN_BYTE[((n - before) * np.uint64(256) + (bits >> place & np.uint64(0xFF))).astype(np.int64)]


class Bits:
    """A bit vector with select for ones or zeros."""

    def __init__(self, words: np.ndarray, places: np.ndarray, ones: bool):
        self.words, self.places, self.ones = words, places, ones

    @staticmethod
    def directory(flags: np.ndarray) -> np.ndarray:
        """Places of every 64th set flag."""
        return np.flatnonzero(flags)[::EVERY].astype(np.uint32)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th bit of the kind (from 0); all k must exist."""
        if not len(k):
            return np.zeros(0, np.int64)
        place = self.places[k // EVERY].astype(np.int64)
        left = (k % EVERY).astype(np.int64)
        word = place >> 6
        bits = self._word(word) & (np.uint64(0xFFFFFFFFFFFFFFFF) << (place & 63).astype(np.uint64))
        count = np.bitwise_count(bits).astype(np.int64)
        active = np.flatnonzero(count <= left)
        while len(active):
            left[active] -= count[active]
            word[active] += 1
            bits[active] = self._word(word[active])
            count[active] = np.bitwise_count(bits[active])
            active = active[count[active] <= left[active]]
        return word * 64 + _nth(bits, left.astype(np.uint64))

    def _word(self, i: np.ndarray) -> np.ndarray:
        found = self.words[i]
        return found if self.ones else ~found


class EliasFano:
    """Lower bits packed, upper bits in unary. The arrays may be views of a mapped file."""

    NAMES = ("shape", "low", "high", "ones", "zeros")

    def __init__(self, shape, low, high, ones, zeros):
        self.n, self.bits = int(shape[0]), int(shape[1])
        self.low = np.ndarray((max(0, len(low) - 7),), "<u8", low, strides=(1,)) if len(low) >= 8 else np.zeros(0, np.uint64)
        self.one, self.zero = Bits(high, ones, True), Bits(high, zeros, False)
        raw = high.view(np.uint8)
        self.high = np.ndarray((max(0, len(raw) - 7),), "<u8", raw, strides=(1,)) if len(raw) >= 8 else np.zeros(0, np.uint64)
        self.buckets = int(shape[2])

    @classmethod
    def arrays(cls, values: np.ndarray) -> tuple[np.ndarray, ...]:
        """The arrays that hold sorted numbers (below 2^62)."""
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        flat = (values[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel() if bits else np.zeros(0, np.uint8)
        low = np.concatenate([np.packbits(flat, bitorder="little"), np.zeros(8, np.uint8)])
        buckets = (universe - 1 >> bits) + 1 if n else 0
        length = -(-(n + buckets + 1) // 64) * 64
        flags = np.zeros(length, bool)
        flags[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = True
        high = np.concatenate([np.packbits(flags, bitorder="little"), np.zeros(8, np.uint8)]).view("<u8")
        return np.array([n, bits, buckets], np.int64), low, high, Bits.directory(flags), Bits.directory(~flags)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        return self.low[at >> 3] >> (at & 7).astype(np.uint64) & np.uint64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        return (self.one.select(i) - i).astype(np.uint64) << np.uint64(self.bits) | self._low(i)

    def _bucket(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first number of a bucket and after its last: the ones behind the zero that ends the bucket before."""
        at = np.zeros(len(bucket), np.int64)
        some = bucket > 0
        at[some] = self.zero.select(bucket[some] - 1) + 1
        start = at - bucket
        seen = self.high[at >> 3] >> (at & 7).astype(np.uint64)
        n = np.bitwise_count(seen ^ (seen + np.uint64(1))).astype(np.int64) - 1
        many = n > 56  # more than the bits read from one place
        if many.any():
            n[many] = self.zero.select(bucket[many]) - at[many]
        return start, start + n

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted number (the first, if repeated), or -1: the successor within its bucket, if it is equal."""
        wanted = wanted.astype(np.uint64)
        bucket = (wanted >> np.uint64(self.bits)).astype(np.int64)
        inside = bucket < self.buckets
        bucket = np.where(inside, bucket, 0)
        low = wanted & np.uint64((1 << self.bits) - 1)
        if not self.n:
            return np.full(len(wanted), -1, np.int64)
        place, end = self._bucket(bucket)
        end = np.where(inside, end, 0)
        active = np.flatnonzero(place < end)
        hit = np.full(len(wanted), -1, np.int64)
        while len(active):
            found = self._low(place[active])
            equal = found == low[active]
            hit[active[equal]] = place[active[equal]]
            active = active[found < low[active]]
            place[active] += 1
            active = active[place[active] < end[active]]
        return hit
