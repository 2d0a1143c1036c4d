"""Words of UTF-8 texts and their 64-bit hashes, for whole Arrow batches at once.

A word is a longest run of bytes other than 0x20 and 0x09 to 0x0D, which is the same on bytes and on code points.
A hash takes in eight bytes at a time and mixes after each, beginning with the length, so words of up to eight bytes
never share one within a length; words above LONG bytes get a BLAKE2b digest.  No hash is a sum over a word's bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LONG = 512
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], U)
#: Odd multipliers for the places of a short sequence of word hashes.
PLACES = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and row of every word."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(ends, begin, side="right") - 1


def hashed(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes; with lower, A-Z count as a-z."""
    data = LOWER[data] if lower else data
    size = end - begin
    out = mix(size.astype(U) + U(0x9E3779B97F4A7C15))
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    left = np.flatnonzero(size <= LONG)
    at, rest = begin[left], size[left]
    while len(left):
        chunk = eight[at].view("<u8")[:, 0] & _MASKS[np.minimum(rest, 8)]
        out[left] = mix(out[left] ^ chunk)
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for i in np.flatnonzero(size > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[begin[i] : end[i]], digest_size=8).digest(), "little")
    return out


def spaced(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where each begins and ends there."""
    size = end - begin
    front = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 32, np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[~SPACE[data]]
    return out.tobytes(), front, front + size


def digests(data: np.ndarray | bytes, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A BLAKE2b digest of 128 bits of each span of bytes, as two columns of 64 bits; with lower, A-Z count as a-z."""
    raw = data if isinstance(data, bytes) else (LOWER[data] if lower else data).tobytes()
    made = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    return np.frombuffer(b"".join(made), U).reshape(-1, 2)


def sequences(word: np.ndarray, begin: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of each span of at least four consecutive word hashes: taken in by four, mixed after each."""
    if not len(begin):
        return np.zeros(0, U)
    four = np.zeros(len(word) - 3, U)
    for i in range(4):
        four += word[i : len(word) - 3 + i] * PLACES[i]
    out = mix((end - begin).astype(U) + U(salt * 2 + 1))
    left, at = np.arange(len(begin)), begin
    while len(left):
        # The last four may overlap those before.
        out[left] = mix(out[left] ^ mix(four[np.minimum(at, end[left] - 4)]))
        more = at + 4 < end[left]
        left, at = left[more], at[more] + 4
    return out


def runs(word: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each k consecutive words of one row, and the index of the first of them."""
    if len(word) < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(row[k - 1 :] == row[: len(row) - k + 1])
    total = np.zeros(len(at), U)
    for i in range(k):
        total += word[at + i] * PLACES[i]
    return mix(total), at
