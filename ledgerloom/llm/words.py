"""Words, byte runs and windows of many texts at once, as numpy arrays over one buffer.

A column of texts is one run of UTF-8 bytes with offsets. Words are found with
byte classes, so all character classes here are sets of ASCII bytes plus "all
bytes of 0x80 and above". Hashes are 64 bits and depend on the bytes alone:
polynomials of the bytes modulo 2^64, many words at a time; words of over 32
bytes are digested one by one, as long alternating patterns can make two
polynomials equal whatever their multiplier is.
"""
from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19  # bytes hashed at a time, so that the arrays stay in cache
LONG = 32        # bytes of a word from which it is digested


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low:high + 1] = True
    return out


BLANKS = _bytes((0x20, 0x20), (0x09, 0x0D))
UNBLANK = ~BLANKS
ALNUM = _bytes((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
AS_IS = np.arange(256, dtype=np.uint8)
FOLDED = AS_IS.copy()
FOLDED[0x41:0x5B] += 0x20  # A-Z to a-z; other letters stay

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def powers(n: int, sign: int = 1) -> np.ndarray:
    """The multiplier's powers 0 to n-1 (or those of its inverse), modulo 2^64."""
    if len(_POWERS[sign]) < n:
        grown = np.full(max(n, PIECE + 4096), _STEP if sign > 0 else _BACK, np.uint64)
        grown[0] = 1
        _POWERS[sign] = np.cumprod(grown, dtype=np.uint64)
    return _POWERS[sign][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits evenly (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` with the inverse, of numbers that are not negative: values and places are sorted as one number.

    If both do not fit 64 bits the lowest bits of the values are left out, and if two values then look alike, np.unique decides.
    """
    n = len(values)
    if n == 0:
        return values, np.zeros(0, np.int64)
    bits = n.bit_length()
    shift = np.uint64(max(0, int(values.max()).bit_length() + bits - 64))
    keys = values.astype(np.uint64) >> shift << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    keys.sort()
    order = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    ranked = values[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if shift:
        heads = keys >> np.uint64(bits)
        if (new[1:] & (heads[1:] == heads[:-1])).any():
            return np.unique(values, return_inverse=True)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[new], inverse


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes; the order matters."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ np.uint64(0xA5A5A5A55A5A5A5A)))


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and offsets (one more than texts); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


class Words(NamedTuple):
    hash: np.ndarray   # of each word
    start: np.ndarray  # first byte
    end: np.ndarray    # byte after the last
    first: np.ndarray  # of each text: its first word; one more entry than texts

    @property
    def stop(self) -> np.ndarray:
        """For each word, the number of the first word of the next text."""
        return np.repeat(self.first[1:], np.diff(self.first))

    @property
    def text(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find(data: np.ndarray, at: np.ndarray, inside: np.ndarray = UNBLANK, fold: np.ndarray = AS_IS) -> Words:
    """Words are the longest runs of bytes of the class ``inside``; no word spans two texts."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(at), np.int64))
    is_in = inside[data]
    edge = np.unique(at[(at > 0) & (at < n)])
    begins, ends = is_in.copy(), is_in.copy()
    begins[1:] &= ~is_in[:-1]
    ends[:-1] &= ~is_in[1:]
    begins[edge] = is_in[edge]
    ends[edge - 1] = is_in[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    values, hashes = _VALUES[fold], np.empty(len(start), np.uint64)
    cuts = np.searchsorted(start, np.arange(0, n, PIECE)).tolist() + [len(start)]
    for i, j in zip(cuts, cuts[1:]):
        if i == j:
            continue
        a, b = int(start[i]), int(end[j - 1])
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(values[data[a:b]] * powers(b - a), out=sums[1:])
        s, e = start[i:j] - a, end[i:j] - a
        hashes[i:j] = mix((sums[e] - sums[s]) * powers(b - a, -1)[s] + (e - s).astype(np.uint64))
    for k in np.flatnonzero(end - start > LONG).tolist():
        raw = fold[data[start[k]:end[k]]].tobytes()
        hashes[k] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return Words(hashes, start, end, np.searchsorted(start, at))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive entries, by doubling; one for each start that has n."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, size = h, 1
    while size * 2 <= n:
        out = pair(out[:-size], out[size:])
        size *= 2
    if size < n:
        k = len(h) - n + 1
        out = pair(out[:k], out[n - size:n - size + k])
    return out


def whole(first: np.ndarray, n: int) -> np.ndarray:
    """Which starts have n entries within their own text (for starts up to the last that has n at all)."""
    total = int(first[-1])
    if total < n:
        return np.zeros(0, bool)
    stop = np.repeat(first[1:], np.diff(first))
    return (np.arange(total) + n <= stop)[:total - n + 1]


def sliding(values: np.ndarray, n: int, pick=np.minimum) -> np.ndarray:
    """Least (or largest) of each n consecutive values."""
    if len(values) < n:
        return values[:0]
    out, size = values, 1
    while size * 2 <= n:
        out = pick(out[:-size], out[size:])
        size *= 2
    if size < n:
        k = len(values) - n + 1
        out = pick(out[:k], out[n - size:n - size + k])
    return out


def least_places(values: np.ndarray, n: int) -> np.ndarray:
    """Place of the least (by its upper 40 bits, then the leftmost) of each n consecutive values; n up to 2^23."""
    low = np.uint64((1 << 24) - 1)
    place = np.arange(len(values), dtype=np.uint64)
    found = sliding((values & ~low) | (place & low), n) & low
    start = place[:len(found)]
    return (start + ((found - start) & low)).astype(np.int64)


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` entries lie in a window of that length at one of the starts."""
    change = np.bincount(starts, minlength=total + 1).astype(np.int64)
    change[length:] -= np.bincount(starts + length, minlength=total + 1)[length:total + 1]
    return np.cumsum(change[:total]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
