"""64-bit hashes of words and of windows of words."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes a Python worker remembers at a time; longer words than this are not remembered.
CACHE_WORDS, CACHE_LENGTH = 500_000, 200


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        v = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_LENGTH:
            self[word] = v
        return v


_codes = _Codes()


def word_codes(raw: bytes) -> np.ndarray:
    """Hashes of the words of a text: runs without ASCII white space, A-Z lower-cased."""
    words = raw.lower().split()
    if len(_codes) > CACHE_WORDS:
        _codes.clear()
    return np.fromiter(map(_codes.__getitem__, words), np.uint64, len(words))


def spread(h: np.ndarray) -> np.ndarray:
    """Mixes the bits, one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as they were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, min(2 * len(self.up), 1 << 20), 4096)
            made = []
            for base in (int(_ODD), pow(int(_ODD), -1, 2**64)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                made.append(np.cumprod(x, dtype=np.uint64))
            if size > 1 << 20:  # for one very long text: not kept
                return made[0][:n], made[1][:n]
            self.up, self.down = made
        return self.up[:n], self.down[:n]


_powers = _Powers()


def window_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each window of n words; fewer words, but not none, are one window.

    A window's hash is a polynomial over its words' hashes, from the difference of two running sums, all modulo 2^64; its
    bits are mixed with its length.
    """
    size = min(n, len(codes))
    if not size:
        return codes
    up, down = _powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * down, out=sums[1:])
    return spread((sums[size:] - sums[:-size]) * up[: len(codes) - size + 1] + np.uint64(size * int(_ODD) % 2**64))
