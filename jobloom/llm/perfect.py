"""A minimal perfect hash over 64-bit keys, with stored fingerprints.

Keys fall level by level into bit arrays of twice their number; a key alone on its bit is
placed there, the others go on to the next level under another seed. A key's number is the
count of set bits before its own, so n keys get the numbers 0 to n-1 with some three bits a
key, and a look-up touches a constant expected number of words. A fingerprint of 32 bits tells
keys that were never stored (one in 2**32 of those is taken for a stored one).
"""

from __future__ import annotations

import numpy as np

GAMMA = 2.0
MAX_LEVELS = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over key and seed."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Bits of each level, and all levels' bits in words of 64. Keys must be distinct."""
    left, sizes, words = keys.astype(np.uint64), [], []
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("keys are not distinct")
        size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
        at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        left = left[~alone[at]]
    return sizes, np.concatenate(words) if words else np.zeros(0, np.uint64)


class PerfectHash:
    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where no level holds it."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = (mix(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = (self.words[word] >> bit) & np.uint64(1) == 1
            w, b = word[found], bit[found]
            below = self.words[w] & ((np.uint64(1) << b) - np.uint64(1))
            out[todo[found]] = self.before[w] + np.bitwise_count(below)
            todo = todo[~found]
        return out
