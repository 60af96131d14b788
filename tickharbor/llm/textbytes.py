"""Vector helpers over the UTF-8 bytes of Arrow string columns, shared by the operators' tasks.

A column is seen as one byte array with the offsets of its rows. Long columns are worked on in
blocks of whole rows, so that temporary arrays stay small whatever the length of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x30:0x3A] = _PLAIN[0x41:0x5B] = _PLAIN[0x61:0x7B] = _PLAIN[0x80:] = True

_RANDOM = np.random.default_rng(20_240_131)
_BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes; a longer row has a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class SpanHash:
    """Hashes of many byte ranges of one array, from prefix sums of a polynomial modulo 2**64."""

    _up = np.ones(1, dtype=np.uint64)
    _down = np.ones(1, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        self._reserve(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[data] * self._up[:len(data)], out=self.sums[1:])

    @classmethod
    def _reserve(cls, size: int) -> None:
        while len(cls._up) < size:
            step = len(cls._up)
            cls._up = np.concatenate([cls._up, cls._up * np.uint64(pow(_BASE, step, 1 << 64))])
            cls._down = np.concatenate([cls._down, cls._down * np.uint64(pow(_BASE_INVERSE, step, 1 << 64))])

    @classmethod
    def shrink(cls) -> None:
        """Forget powers beyond those that a block of usual texts needs."""
        if len(cls._up) > 2 * BLOCK_BYTES:
            cls._up, cls._down = cls._up[:2 * BLOCK_BYTES].copy(), cls._down[:2 * BLOCK_BYTES].copy()

    def windows(self, length: int) -> np.ndarray:
        """The hashes of all ranges of one length, as ``of`` would give them."""
        sums = (self.sums[length:] - self.sums[:-length]) * self._down[:len(self.sums) - length]
        return mix(sums + np.uint64(length))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = (self.sums[ends] - self.sums[starts]) * self._down[starts]
        return mix(sums + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray | None = None) -> tuple[
        np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are no ASCII white space), and each row's first word.

    ``offsets`` are those of the rows within ``data``; the last array has one more entry than rows. ``solid``
    tells which bytes are part of words, where that is other than all but white space.
    """
    if not len(data):
        none = np.empty(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    solid = ~SPACE[data] if solid is None else solid
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    finishes[:-1] &= ~solid[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = solid[edges]
    edges = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    finishes[edges] = solid[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each lower-cased word, and each row's first word."""
    starts, ends, firsts = word_spans(data, offsets)
    return SpanHash(LOWER[data]).of(starts, ends), firsts


def plain_word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes``, for runs of letters and digits only: case (up to U+00DE) and punctuation do not count."""
    folded = LOWER[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    folded[upper] += 0x20
    starts, ends, firsts = word_spans(data, offsets, _PLAIN[data])
    return SpanHash(folded).of(starts, ends), firsts
