"""Arrays over the raw bytes of Arrow text columns: words, hashes, shingle sets. No string objects are made."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256)
LOWER[65:91] += 32
#: Letters, digits and all bytes of other scripts: what plain words are made of.
PLAIN = np.zeros(256, bool)
PLAIN[48:58] = PLAIN[65:91] = PLAIN[97:123] = PLAIN[128:] = True
#: Also lower-cases the two-byte Latin letters, whose second byte differs by 32; other scripts may coincide, which hashing allows for.
LOWER_WIDE = LOWER.copy()
LOWER_WIDE[0x80:0x9F] += 32
BYTE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)  # a random number for each byte value
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64."""
    have = _powers[base]
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; row i is bytes[offsets[i]:offsets[i + 1]]."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray = ~SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and at last their number) of the runs of chars."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = chars[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][some], offsets[1:][some] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def prefix_hashes(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Sums from which span_hashes takes the hash of any span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(BASE, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 3) -> list[np.ndarray]:
    """Of each row, the sorted distinct hashes of its n-word shingles, A-Z lower-cased; a shorter row is one shingle, an empty one none."""
    starts, ends, first = words(data, offsets)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    h = span_hashes(prefix_hashes(data, BYTE[LOWER]), starts, ends)
    rolled = h.copy()
    for k in range(1, min(n, len(h))):
        rolled[: len(h) - k] = mix(rolled[: len(h) - k] + np.uint64(k)) + h[k:]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            s = np.sort(rolled[a : b - n + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            whole = np.uint64(b - a)
            for x in h[a:b]:
                whole = mix(np.array([whole], np.uint64))[0] ^ x
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
