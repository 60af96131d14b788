"""Packing documents into training sequences by patterns of few lengths.

The plan needs the histogram of piece lengths only, so its size depends on the sequence length and not
on the number of documents. Patterns of one to three lengths that fill a sequence exactly are enumerated;
non-negative least squares fit how often each is repeated; repeats are rounded down within what the
histogram has; what is left is packed best fit first, longest pieces first, by length and count. Pieces
then find their places from their rank among all pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickharbor.llm.encoding import SLOTS, TASK_SLOTS, encoder
from tickharbor.llm.memory import freed
from tickharbor.session import stored

FIT_STEPS = 200
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, block int, place long"


def patterns(capacity: int) -> np.ndarray:
    """Lengths of one to three pieces that fill a sequence, in descending order; 0 where a pattern has fewer."""
    a = np.arange(capacity + 1)
    low, mid = np.meshgrid(a, a, indexing="ij")
    high = capacity - low - mid
    use = (low <= mid) & (mid <= high)
    return np.stack([high[use], mid[use], low[use]], axis=1)


def fit_repeats(histogram: np.ndarray, shapes: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative repeats of the patterns whose length counts are least squares to the histogram.

    Multiplicative steps: the values stay non-negative and the error never grows.
    """
    def used(x: np.ndarray) -> np.ndarray:
        counts = sum(np.bincount(shapes[:, k], x, len(histogram)) for k in range(shapes.shape[1]))
        counts[0] = 0
        return counts

    def gathered(values: np.ndarray) -> np.ndarray:
        return values[shapes].sum(axis=1)

    target = histogram.astype(float)
    target[0] = 0
    aim = gathered(target)
    repeats = np.where(aim > 0, aim / max(1.0, len(shapes) ** 0.5), 0.0)
    for _ in range(steps):
        repeats *= aim / np.maximum(gathered(used(repeats)), 1e-12)
    return repeats


@dataclass
class Plan:
    """Slots sorted by (length, first rank): ranks from ``rank`` on go to sequences from ``sequence`` on, at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, last = np.searchsorted(self.length, length, "left"), np.searchsorted(self.length, length, "right")
        while True:  # binary search for the last slot at or below each rank
            open_ = last - first > 1
            if not open_.any():
                break
            middle = (first + last) // 2
            below = self.rank[np.minimum(middle, len(self.rank) - 1)] <= rank
            first, last = np.where(open_ & below, middle, first), np.where(open_ & ~below, middle, last)
        return self.sequence[first] + rank - self.rank[first], self.offset[first]


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit of lengths in descending order, many equal sequences at a time: contents and their number."""
    spaces: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            space = next((s for s in range(length, capacity) if spaces[s]), None)
            if space is None:
                each = capacity // length
                whole, part = divmod(left, each)
                if whole:
                    spaces[capacity - each * length].append(((length,) * each, whole))
                if part:
                    spaces[capacity - part * length].append(((length,) * part, 1))
                break
            contents, number = spaces[space].pop()
            taken = min(left, number)
            if number > taken:
                spaces[space].append((contents, number - taken))
            spaces[space - length].append((contents + (length,), taken))
            left -= taken
    return [group for groups in spaces.values() for group in groups]


def make_plan(histogram: np.ndarray, capacity: int) -> Plan:
    """A plan for ``histogram[length]`` pieces of each length up to ``capacity``."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    groups: list[tuple[tuple[int, ...], int]] = []
    if left.any():
        shapes = patterns(capacity)
        shapes = shapes[(left[shapes] + (shapes == 0) > 0).all(axis=1)]
        repeats = fit_repeats(left, shapes)
        for at in np.argsort(-repeats, kind="stable"):
            if repeats[at] < 1:
                break
            contents = tuple(int(x) for x in shapes[at] if x)
            times = min([int(repeats[at])] + [int(left[x]) // contents.count(x) for x in set(contents)])
            if times:
                groups.append((contents, times))
                for x in contents:
                    left[x] -= times
        groups += best_fit(left, capacity)
    next_rank, slots, sequence = np.zeros(capacity + 1, dtype=np.int64), [], 0
    for contents, times in groups:
        offset = 0
        for length in contents:
            slots.append((length, int(next_rank[length]), sequence, offset))
            next_rank[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 4)
    return Plan(*(table[:, k] for k in range(4)), sequences=sequence)


def _cutter(vocabulary: str, end_id: int, capacity: int, slots: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        tool = encoder(vocabulary, slots)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tool.encode(batch.column("text"), end_id)):
                ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity)
                for piece, end in enumerate(ends):
                    start = max(0, end - capacity) if piece else 0
                    rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end]), block, int(seen[end - start])))
                    seen[end - start] += 1
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, row)) for row in rows], schema=_SCHEMA)

    return cut


_NAMES = ("doc_id", "piece", "start", "length", "ids_crc32", "block", "place")
_SCHEMA = pa.schema([(name, pa.int32() if name in ("piece", "block") else pa.int64()) for name in _NAMES])


def cut_pieces(documents: DataFrame, vocabulary: str, end_id: int, capacity: int, keep_encoder: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids, the first one shorter; ``place`` counts pieces of a length within a ``block``."""
    cutter = _cutter(vocabulary, end_id, capacity, SLOTS if keep_encoder else TASK_SLOTS)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(cutter if keep_encoder else freed(cutter), PIECE)


def _placer(plan: Plan):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield batch.drop_columns(["rank"]).append_column("sequence_id", pa.array(sequence, pa.int64())) \
                .append_column("offset", pa.array(offset, pa.int64()))

    return place


def pack(documents: DataFrame, vocabulary: str, end_id: int, capacity: int = 1024, keep_encoder: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document.

    A null or empty text is the end id alone. Rows that repeat a ``doc_id``, or have none, are documents of
    their own. Other columns are ignored; an empty table gives no rows. Texts are encoded once and their
    pieces stored; only counts by length and task move to find ranks, so equal lengths never meet in a task.
    Without ``keep_encoder`` workers have a smaller one and drop it after each task: slower, but memory stays free.
    """
    pieces = stored(cut_pieces(documents, vocabulary, end_id, capacity, keep_encoder), "pieces")
    counts = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.select("length", "block", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
                    "piece-counts")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row for each length
        histogram[row["length"]] = row["n"]
    ranked = pieces.join(counts.select("length", "block", "first"), ["length", "block"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(_placer(make_plan(histogram, capacity)), "doc_id long, piece int, start long, length long, "
                             "ids_crc32 long, sequence_id long, offset long")
