"""Minimal perfect hashes of sharded vocabularies, looked up for many words at once.

A shard places its keys level by level: a key that has a bit of a level to itself stays there,
the others go on to the next, smaller level. The slot of a key is the number of set bits before
its own, so slots are dense and the keys, stored in slot order, tell members from other words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ordersight.llm.byte_words import mix
from ordersight.llm.letter_runs import Runs, same_bytes

#: Bits for each key that a level still has to place, and levels at most.
BITS_PER_KEY = 2
LEVELS = 24
_COUNT = np.array([bin(i).count("1") for i in range(256)], np.int64)
_LEVEL_SEEDS = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64) for k in range(LEVELS)]


def _places(hashes: np.ndarray, level: int, bits: np.ndarray | int) -> np.ndarray:
    return (mix(hashes ^ _LEVEL_SEEDS[level]) % np.asarray(bits, np.uint64)).astype(np.int64)


def build(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of each level, all bits, keys in slot order, keys without a slot) of one shard.

    Keys without a slot have the hash of another one.
    """
    sizes, levels, order = [], [], []
    left = np.arange(len(hashes))
    for level in range(LEVELS):
        if not len(left):
            break
        size = -(-BITS_PER_KEY * len(left) // 8)
        places = _places(hashes[left], level, 8 * size)
        alone = np.bincount(places, minlength=8 * size)[places] == 1
        flags = np.zeros(8 * size, np.uint8)
        flags[places[alone]] = 1
        sizes.append(size)
        levels.append(np.packbits(flags, bitorder="little"))
        order.append(left[alone][np.argsort(places[alone])])
        left = left[~alone]
    bits = np.concatenate(levels) if levels else np.zeros(0, np.uint8)
    return np.array(sizes, np.int64), bits, np.concatenate(order) if order else left, left


def _lengths_and_bytes(keys: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = keys.buffers()
    offsets = np.frombuffer(offsets, np.int32)[keys.offset : keys.offset + len(keys) + 1]
    return np.diff(offsets).astype(np.int64), np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]


class Shards:
    """Perfect hashes of several shards, each with its stored keys."""

    def __init__(self, sizes: list[np.ndarray], bits: list[np.ndarray], keys: list[pa.Array]):
        n = len(sizes)
        self.sizes = np.zeros((n, LEVELS), np.int64)
        for at, of_levels in enumerate(sizes):
            self.sizes[at, : len(of_levels)] = of_levels
        flat = np.cumsum(self.sizes.ravel()) - self.sizes.ravel()
        self.starts = flat.reshape(n, LEVELS)
        self.bits = np.concatenate([*bits, np.zeros(0, np.uint8)])
        counts = _COUNT[self.bits]
        self.ranks = np.cumsum(counts) - counts
        stored = [_lengths_and_bytes(k) for k in keys]
        key_counts = np.array([len(k) for k in keys], np.int64)
        self.first_key = np.cumsum(key_counts) - key_counts
        placed = [int(_COUNT[b].sum()) for b in bits]
        self.first_rank = np.cumsum(placed) - placed
        #: Keys that share a hash with another one, by their bytes: practically none.
        self.others = [{k.as_py().encode(): p + i for i, k in enumerate(keys_of[p:])} for p, keys_of in zip(placed, keys)]
        self.has_others = any(self.others)
        self.key_lengths = np.concatenate([*[lengths for lengths, _ in stored], np.zeros(0, np.int64)])
        self.key_starts = np.cumsum(self.key_lengths) - self.key_lengths
        self.key_bytes = np.concatenate([*[data for _, data in stored], np.zeros(0, np.uint8)])

    def find(self, found: Runs, at: np.ndarray, shards: np.ndarray) -> np.ndarray:
        """The slot within its shard of each run ``at``, -1 for a run that is no key."""
        slots = np.full(len(at), -1, np.int64)
        hashes, open_ = found.hashes[at], np.arange(len(at))
        for level in range(LEVELS):
            bits = 8 * self.sizes[shards[open_], level]
            open_ = open_[bits > 0]
            if not len(open_):
                break
            places = 8 * self.starts[shards[open_], level] + _places(hashes[open_], level, 8 * self.sizes[shards[open_], level])
            byte, bit = self.bits[places >> 3], places & 7
            hit = (byte >> bit) & 1 == 1
            slots[open_[hit]] = (self.ranks[places >> 3] + _COUNT[byte & ((1 << bit) - 1)])[hit] - self.first_rank[shards[open_[hit]]]
            open_ = open_[~hit]
        # The stored key decides whether the word is a member.
        hit = np.flatnonzero(slots >= 0)
        key = self.first_key[shards[hit]] + slots[hit]
        lengths = found.ends[at[hit]] - found.starts[at[hit]]
        member = lengths == self.key_lengths[key]
        member[member] = same_bytes(found.data, found.starts[at[hit[member]]], self.key_bytes, self.key_starts[key[member]], lengths[member])
        slots[hit[~member]] = -1
        if self.has_others:
            for i in np.flatnonzero(slots < 0):
                slots[i] = self.others[shards[i]].get(found.text(at[i]), -1)
        return slots
