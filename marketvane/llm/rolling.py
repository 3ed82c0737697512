"""Vectorised hashes of stretches of code units: fixed-length grams and words.

A stretch is hashed as a polynomial modulo 2^64 with an odd base, so prefix sums give every stretch's
value at once and the base's inverse moves it to a common origin; a finishing mix spreads the bits.
Long inputs are hashed piece by piece, so memory does not grow with a text.
"""

from __future__ import annotations

from functools import cache
from hashlib import blake2b

import numpy as np

#: Code units hashed at once.
PIECE = 1 << 17
BASE = 0x9E3779B97F4A7C15

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and those of its inverse."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(2 * PIECE, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _sums(codes: np.ndarray) -> np.ndarray:
    powers, _ = _powers()
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)], out=sums[1:])
    return sums


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k consecutive codes, by start; k is below PIECE."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, inverse = _powers()
    out = np.empty(n, np.uint64)
    for at in range(0, n, PIECE):
        sums = _sums(codes[at : at + PIECE + k - 1])
        own = len(sums) - k
        out[at : at + own] = mix((sums[k:] - sums[:-k]) * inverse[:own])
    return out


def inner_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span, overlapping or not, of at most 2 * PIECE codes."""
    sums = _sums(codes)
    return mix((sums[ends] - sums[starts]) * _powers()[1][starts])


def word_bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes, split at ASCII spaces."""
    edge = np.diff(np.concatenate(([True], _SPACE[text], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span; spans are in order and apart."""
    _, inverse = _powers()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        origin = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, origin + PIECE, "right")))
        if ends[upto - 1] - origin > PIECE:  # one huge word
            out[at] = np.uint64(int.from_bytes(blake2b(codes[origin : ends[at]].tobytes(), digest_size=8).digest(), "little"))
        else:
            sums = _sums(codes[origin : ends[upto - 1]])
            first, last = starts[at:upto] - origin, ends[at:upto] - origin
            out[at:upto] = mix((sums[last] - sums[first]) * inverse[first])
        at = upto
    return out


def shingles(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct hashes of each n consecutive words; a shorter text with words is one shingle."""
    codes = np.frombuffer(text, np.uint8)
    words = span_hashes(codes, *word_bounds(codes))
    if not len(words):
        return words
    n = min(n, len(words))
    value = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        value = value * np.uint64(BASE) + words[k : len(words) - n + 1 + k]
    return np.unique(mix(value))
