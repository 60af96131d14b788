"""A minimal perfect hash of integer keys: levels of bit arrays, each holding the keys that meet no other there."""

from __future__ import annotations

from typing import BinaryIO

import numpy as np

from tickharbor.llm.textbytes import mix

GAMMA = 1.5
_STEP = 0x9E3779B97F4A7C15
_MARK = np.uint64(0xD1B54A32D192ED03)


def _seed(level: int) -> np.uint64:
    return np.uint64((_STEP * (level + 1)) & 0xFFFFFFFFFFFFFFFF)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key that are independent of its place, to tell foreign keys."""
    return (mix(keys.view(np.uint64) ^ _MARK) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Maps n distinct 64-bit keys to 0..n-1; a key takes the place of its bit on the first level where it is alone."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes = sizes
        self.words = words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, parts = keys.view(np.uint64), [], []
        while len(left):
            size = int(len(left) * GAMMA) // 64 + 1
            place = (mix(left ^ _seed(len(sizes))) % np.uint64(size * 64)).astype(np.int64)
            alone = np.bincount(place, minlength=size * 64) == 1
            words = np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64)
            sizes.append(size)
            parts.append(words)
            left = left[~alone[place]]
        return cls(sizes, np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64))

    def __len__(self) -> int:
        return int(self.ranks[-1])

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where no level has it; a foreign key may get any place."""
        keys = keys.view(np.uint64)
        found = np.full(len(keys), -1, dtype=np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            place = (mix(keys[open_] ^ _seed(level)) % np.uint64(size * 64)).astype(np.int64)
            word, bit = base + place // 64, (place % 64).astype(np.uint64)
            here = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.ranks[word] + np.bitwise_count(below)
            found[open_[here]] = rank[here]
            open_, base = open_[~here], base + size
        return found

    def write(self, file: BinaryIO) -> None:
        file.write(np.array([len(self.sizes), *self.sizes], dtype="<i8").tobytes())
        file.write(self.words.astype("<u8").tobytes())

    @classmethod
    def read(cls, data: memoryview) -> tuple[PerfectHash, int]:
        """The hash at the beginning of ``data`` and the number of bytes it takes."""
        levels = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", levels, 8).tolist()
        words = np.frombuffer(data, "<u8", sum(sizes), 8 + 8 * levels).astype(np.uint64)
        return cls(sizes, words), 8 + 8 * levels + 8 * len(words)
