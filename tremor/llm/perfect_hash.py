"""Minimal perfect hash of distinct 128-bit keys, as levels of bit arrays.

A level hashes its keys into twice as many slots; a key alone in its slot sets that slot's bit, the others go to the next
level. A key's index is the number of bits set before its own over all levels, so n keys have the indexes 0 to n - 1 in
about four bits each. A key that was not built in gets some index or -1: callers hold fingerprints against it.
"""

from __future__ import annotations

import numpy as np

from tremor.llm.common import mix

U64 = np.uint64
SLOTS_PER_KEY = 2


def _slots(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(high + mix(low + U64(level) * U64(0x9E3779B97F4A7C15))) % U64(size)


class PerfectHash:
    """``sizes``: slots per level (multiples of 64); ``words``: the bit arrays of all levels, 64 slots a word."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        set_bits = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(set_bits) - set_bits

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> "PerfectHash":
        sizes, words, left = [], [np.zeros(0, U64)], np.arange(len(high))
        while len(left):
            size = -(-SLOTS_PER_KEY * len(left) // 64) * 64
            slot = _slots(high[left], low[left], len(sizes), size).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(U64))
            sizes.append(size)
            left = left[~alone[slot]]
        return cls(np.array(sizes, np.int64), np.concatenate(words))

    def lookup(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for some keys that were not built in."""
        out, left, base = np.full(len(high), -1, np.int64), np.arange(len(high)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            slot = _slots(high[left], low[left], level, size)
            word, bit = base + (slot >> U64(6)).astype(np.int64), slot & U64(63)
            value = self.words[word]
            hit = (value >> bit) & U64(1) == 1
            below = np.bitwise_count(value[hit] & ((U64(1) << bit[hit]) - U64(1))).astype(np.int64)
            out[left[hit]] = self.before[word[hit]] + below
            left, base = left[~hit], base + size // 64
        return out
