"""Token ids of many texts with a public tokenizer, each different unit of text encoded once.

The tokenizer splits a text before it applies its merges, and never joins what stands on both sides of
certain places: the end of a word before a space, or an ASCII letter before ASCII punctuation other than
an apostrophe. Texts are cut into units at such places only, so the ids of a text are those of its units
in order. Units are found and hashed with vector operations and looked up in a table of fixed size; units
that are not there are encoded by the tokenizer. A text with the mark of a special token is one unit.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tickharbor.llm.textbytes import LOWER, SpanHash, column_bytes, row_blocks

SLOTS = 1 << 22
# Entries where an encoder lives for one task only, which sees fewer units.
TASK_SLOTS = 1 << 19
POOL_IDS = 1 << 24
# Units that the tokenizer takes at once; its results are many times larger than their ids.
UNITS = 1 << 12

# Classes of bytes, one bit each. First bytes of two-byte characters count from U+00C0 on, none of which is white space.
_BLANK, _PRINTED, _LETTER, _MARK, _TAIL, _PAIR, _LESS, _BAR = (np.uint8(1 << k) for k in range(8))
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x0A]] |= _BLANK
_CLASS[0x21:0x7F] |= _PRINTED | _MARK
_CLASS[0x30:0x3A] &= ~_MARK
_CLASS[0x27] &= ~_MARK
for _first in (0x41, 0x61):
    _CLASS[_first:_first + 26] &= ~_MARK
    _CLASS[_first:_first + 26] |= _LETTER
_CLASS[0x80:0xC0] |= _TAIL
_CLASS[0xC3:0xE0] |= _PAIR
_CLASS[0x3C] |= _LESS
_CLASS[0x7C] |= _BAR


class Encoder:
    """Encodes columns of texts; keeps what it has encoded in a table of ``slots`` entries, a power of two."""

    def __init__(self, path: str, slots: int = SLOTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            normalizer = json.load(file)["normalizer"]
        # A tokenizer that lowers letters also drops white space here.
        self.folds = normalizer is not None and "Lowercase" in json.dumps(normalizer)
        self.keys = np.zeros(slots, dtype=np.uint64)
        self.begin = np.zeros(slots, dtype=np.int32)
        self.count = np.zeros(slots, dtype=np.int32)
        self.pool = np.empty(1 << 20, dtype=np.uint32)
        self.used = 0

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the units; the first of each row is among them."""
        if not len(data):
            return np.empty(0, dtype=np.int64)
        kind = _CLASS[data]
        edge = np.zeros(len(data), dtype=bool)
        before, here = kind[:-1], kind[1:]
        blank = (here & _BLANK) != 0
        closed = (before & _PRINTED) != 0
        closed[1:] |= ((before[1:] & _TAIL) != 0) & ((kind[:-2] & _PAIR) != 0)
        edge[1:] = (closed & blank) | (((before & _LETTER) != 0) & ((here & _MARK) != 0))
        if self.folds:
            edge[1:] |= ((before & _BLANK) != 0) & ~blank
        special = np.flatnonzero(((before & _LESS) != 0) & ((here & _BAR) != 0))
        for row in np.unique(np.searchsorted(offsets, special, side="right") - 1):
            edge[offsets[row]:offsets[row + 1]] = False
        edge[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        return np.flatnonzero(edge)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for i in range(0, len(texts), UNITS)
                 for e in self.tokenizer.encode_batch_fast(texts[i:i + UNITS], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter((i for x in found for i in x), dtype=np.uint32, count=int(counts.sum()))
        begin = self.used + np.cumsum(counts) - counts
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(max(len(self.pool), len(ids)), dtype=np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        return begin, counts

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of rows, and where each row's begin."""
        if self.used > POOL_IDS:
            self.keys[:] = 0
            self.used = 0
        starts = self._units(data, offsets)
        ends = np.append(starts[1:], len(data))
        if self.folds:
            solid = (_CLASS[data[starts]] & _BLANK) == 0
            starts, ends = starts[solid], ends[solid]
        hashes = SpanHash(LOWER[data] if self.folds else data).of(starts, ends)
        last = len(self.keys) - 1
        slots = (hashes & np.uint64(last)).astype(np.int64)
        missed = np.flatnonzero(self.keys[slots] != hashes)
        slots[missed] = (hashes[missed] >> np.uint64(40)).astype(np.int64) & last
        begin, count = self.begin[slots].astype(np.int64), self.count[slots].astype(np.int64)
        new = missed[self.keys[slots[missed]] != hashes[missed]]
        if len(new):
            unique, example, place = np.unique(hashes[new], return_index=True, return_inverse=True)
            raw = data.tobytes()
            at = new[example]
            texts = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            new_begin, new_count = self._encode(texts)
            begin[new], count[new] = new_begin[place], new_count[place]
            kept = (unique & np.uint64(last)).astype(np.int64)
            kept = np.where(self.keys[kept] == 0, kept, slots[at])
            self.keys[kept], self.begin[kept], self.count[kept] = unique, new_begin, new_count
        stops = np.cumsum(count)
        shift = np.repeat(begin - (stops - count), count)
        ids = self.pool[shift + np.arange(len(shift))]
        rows = np.concatenate([[0], stops])[np.searchsorted(starts, offsets)]
        return ids, rows

    def encode(self, column: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text, with ``end_id`` after them; a null text has the end alone."""
        data, offsets = column_bytes(column)
        for first, last in row_blocks(offsets):
            own = offsets[first:last + 1] - offsets[first]
            ids, rows = self.encode_block(data[offsets[first]:offsets[last]], own)
            joined = np.insert(ids, rows[1:], end_id).astype("<u4", copy=False)
            bounds = rows + np.arange(len(rows))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield joined[a:b]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, slots: int = SLOTS) -> Encoder:
    """The encoder of a vocabulary file, one for each Python worker."""
    if (path, slots) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, slots] = Encoder(path, slots)
    return _ENCODERS[path, slots]


def forget() -> None:
    """Drop the worker's encoder; the next task loads its own."""
    _ENCODERS.clear()
