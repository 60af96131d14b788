"""Which rows share a file when a file opens with its first row and closes by age or by size.

A file takes rows until the first one that is more than the maximum age after its opening row, or that finds a
multiple of ``look_rows`` rows in a file beyond the maximum size; that row opens the next file. Each opening
depends on the one before, so a key looks like a fold over all its rows. It is not one:

- Time is cut into slices at least as long as the maximum age. Within a slice every row, if a file opened with it,
  has one next opening, found by binary search; following these gives the file open at the slice's end.
- What a slice makes of the file open before it is a table: one row per file that may be open there, from the last
  age of the slice before. A file older than that opens anew with the first row.
- The tables of neighbouring slices compose. The slices' true states are reached from each key's first by doubling, in
  as many rounds as the number of slices has binary digits, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickharbor.functions.scalars import whole
from tickharbor.schemas import WRITER_KEY
from tickharbor.session import ship, stored

# Age and size at which a file is closed, and rows between two looks at its size.
MAX_FILE_AGE_US = 3600 * 1_000_000
MAX_FILE_BYTES = 500 * 1024 * 1024
LOOK_ROWS = 10_000
# Rows that a slice should hold, as far as one age of a key allows.
SLICE_ROWS = 1_000_000
# State of a slice whose first row opens a file whatever was open before.
ANEW = -1

_OPEN = [("opened_us", T.LongType()), ("at_row", T.LongType()), ("at_bytes", T.LongType())]
_PIECE = [*_OPEN, ("last_us", T.LongType()), ("rows", T.LongType()), ("bytes", T.LongType())]


def row_bytes(columns: list[str], times: int = 2) -> Column:
    """Bytes of a row before compression: its texts, and eight for each time."""
    texts = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns])
    return (texts + 8 * times).cast("bigint")


def disk_ratio(manifest: DataFrame, events: DataFrame, columns: list[str]) -> float:
    """Bytes on disk for each byte of the rows, as measured on an archive that was written from them."""
    on_disk = manifest.agg(F.sum("size")).first()[0] or 0
    in_rows = events.agg(F.sum(row_bytes(columns))).first()[0] or 0
    return on_disk / in_rows if in_rows else 1.0


class _Slice:
    """The rows of one key and slice in order, and which opening follows which."""

    def __init__(self, group: pa.Table, age_us: int, most: float | None, look: int) -> None:
        times, sizes = (group.column(c).to_numpy() for c in ("timestamp_collector", "__size"))
        order = np.lexsort((*([group.column("__tie").to_numpy(zero_copy_only=False)] if "__tie" in group.column_names else []), times))
        self.times, self.bytes = times[order], np.r_[0, np.cumsum(sizes[order])]
        self.age_us, self.most, self.look = age_us, most, look
        rows = np.arange(len(times))
        follow = np.searchsorted(self.times, self.times + age_us, side="right")
        if most is not None:
            beyond = np.maximum(np.searchsorted(self.bytes, self.bytes[:-1] + most, side="right"), rows + 1)
            follow = np.minimum(follow, rows - (rows - beyond) // look * look)
        self.next = np.minimum(follow, len(rows))
        # The last opening reached from each row: follow pointers twice as far each time.
        last = np.where(self.next < len(rows), self.next, rows)
        while True:
            further = last[last]
            if (further == last).all():
                break
            last = further
        self.last = last

    def entry(self, opened_us: int, rows: int, size: int) -> int:
        """The first row that opens a file when one with so many rows and bytes is open; the number of rows if none does."""
        found = int(np.searchsorted(self.times, opened_us + self.age_us, side="right"))
        if self.most is not None:
            beyond = int(np.searchsorted(self.bytes, self.most - size, side="right"))
            beyond = max(beyond, 1 - rows)
            found = min(found, beyond + (-(rows + beyond)) % self.look)
        return min(found, len(self.times))


def _key_columns(keys: list[str], schema: T.StructType) -> list[T.StructField]:
    return [schema[key] for key in keys]


def _group(cut: Callable[[pa.Table], _Slice], keys: list[str], columns: list[tuple[str, T.DataType]], rows: Callable) -> Callable:
    """A function of a key's slice (and of the files that may be open there) that returns (columns) behind the key."""
    def run(key: tuple, group: pa.Table, before: pa.Table | None = None) -> pa.Table:
        found = rows(cut(group), group, before) if group.num_rows else []
        part = {name: pa.array([value.as_py()] * len(found), _nullable(value.type)) for name, value in zip([*keys, "__slice"], key)}
        return pa.table({**part, **{name: pa.array([row[i] for row in found], pa.int64()) for i, (name, _) in enumerate(columns)}})

    return run


def _nullable(kind: pa.DataType) -> pa.DataType:
    return pa.struct([pa.field(f.name, f.type) for f in kind]) if pa.types.is_struct(kind) else kind


def _number(table: pa.Table, column: str) -> int:
    return table.column(column)[0].as_py()


def _tail(own: _Slice, group: pa.Table, _: None) -> list[tuple]:
    """Files that may be open at the end of the slice."""
    at_row, at_bytes = _number(group, "__start_row"), _number(group, "__start_bytes")
    return [(int(own.times[r]), at_row + int(r), at_bytes + int(own.bytes[r])) for r in np.flatnonzero(own.next == len(own.times))]


def _steps(own: _Slice, group: pa.Table, before: pa.Table | None) -> list[tuple]:
    """State after the slice for each state before it; both are the row of the open file's opening."""
    at_row, at_bytes = _number(group, "__start_row"), _number(group, "__start_bytes")
    found = [(ANEW, at_row + int(own.last[0]))]
    for opened_us, row, size in zip(*(before.column(c).to_pylist() for c, _ in _OPEN)) if before is not None else ():
        entry = own.entry(opened_us, at_row - row, at_bytes - size)
        # A file that outlasts the slice is too old for the next one.
        found.append((row, at_row + int(own.last[entry]) if entry < len(own.times) else ANEW))
    return found


def _pieces(own: _Slice, group: pa.Table, before: pa.Table | None) -> list[tuple]:
    """The slice's rows by file."""
    at_row, at_bytes = _number(group, "__start_row"), _number(group, "__start_bytes")
    found, start = [], 0

    def piece(opened_us: int, row: int, size: int, end: int) -> None:
        found.append((opened_us, row, size, int(own.times[end - 1]), end - start, int(own.bytes[end] - own.bytes[start])))

    if before is not None and before.num_rows:
        opened_us, row, size = (_number(before, c) for c, _ in _OPEN)
        end = own.entry(opened_us, at_row - row, at_bytes - size)
        if end:
            piece(opened_us, row, size, end)
            start = end
    while start < len(own.times):
        end = int(own.next[start])
        piece(int(own.times[start]), at_row + start, at_bytes + int(own.bytes[start]), end)
        start = end
    return found


def _reached(steps: DataFrame, keys: list[str], slices: int) -> DataFrame:
    """The true state before each slice, from the first of every key, by doubling.

    ``steps`` has (keys, k, state, after): slice number k makes ``after`` of ``state``.
    """
    known = stored(steps.where("k = 0").select(*keys, "k", "state"), "rotation-states")
    jump = steps.select(*keys, "k", "state", F.col("after").alias("to"))
    length = 1
    while length < slices:
        further = known.join(jump, [*keys, "k", "state"]).select(*keys, (F.col("k") + length).alias("k"), F.col("to").alias("state"))
        known = stored(known.unionByName(further), "rotation-states")
        if 2 * length < slices:
            second = jump.select(*keys, (F.col("k") - length).alias("k"), F.col("state").alias("to"), F.col("to").alias("__to"))
            jump = stored(jump.join(second, [*keys, "k", "to"]).select(*keys, "k", "state", F.col("__to").alias("to")), "rotation-jumps")
        length *= 2
    return known


def rotation_files(
    events: DataFrame,
    keys: list[str] = WRITER_KEY,
    age_us: int = MAX_FILE_AGE_US,
    size: Column | None = None,
    max_bytes: float = MAX_FILE_BYTES,
    ratio: float = 1.0,
    look_rows: int = LOOK_ROWS,
    tiebreak: str | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per file: key, opening time, last time, rows, and bytes if there is a ``size``.

    With ``size``, the bytes of a row before compression, files also close when a multiple of ``look_rows`` rows has
    come to more than ``max_bytes`` on disk; ``ratio`` is the bytes on disk for each byte (see ``disk_ratio``).
    Rows of the same time come in the order of ``tiebreak``; by age alone their order does not matter. Keys may be null.
    A slice is held by one task: a key's rows of one age, or more ages where that stays below ``slice_rows``.
    The columns that decide are stored first, so ``events`` are computed once however dear they are.
    """
    ship(events.sparkSession)
    most = None if size is None else max_bytes / ratio
    tie = [F.col(tiebreak).alias("__tie")] if tiebreak else []
    # Null keys are keys like others, and joins must find them.
    key_types = _key_columns(keys, events.schema)
    named = [F.struct(F.col(key)).alias(key) for key in keys]
    rows = stored(events.select(
        *named, "timestamp_collector", *tie, (F.lit(0).cast("bigint") if size is None else size.cast("bigint")).alias("__size")), "rotation-events")
    cells = rows.groupBy(*keys, whole("timestamp_collector", age_us).alias("cell")).agg(F.count("*").alias("n"))
    densest = cells.agg(F.max("n")).first()[0] or 1
    width = age_us * max(1, slice_rows // densest)
    sliced = rows.withColumn("__slice", whole("timestamp_collector", width))
    order = Window.partitionBy(*keys).orderBy("__slice")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    shape = sliced.groupBy(*keys, "__slice").agg(F.count("*").alias("n"), F.sum("__size").alias("b")).select(
        *keys, "__slice", (F.row_number().over(order) - 1).cast("bigint").alias("k"), F.lead("__slice").over(order).alias("__following"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start_row"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("__start_bytes"))
    shape = stored(shape, "rotation-slices")
    slices = (shape.agg(F.max("k")).first()[0] or 0) + 1
    by = [*keys, "__slice"]
    placed = sliced.join(shape.drop("k", "__following"), by)

    def cut(group: pa.Table) -> _Slice:
        return _Slice(group, age_us, most, look_rows)

    def schema(columns: list[tuple[str, T.DataType]]) -> T.StructType:
        return T.StructType([shape.schema[key] for key in by] + [T.StructField(n, t) for n, t in columns])

    if slices == 1:
        run = _group(cut, keys, _PIECE, _pieces)
        pieces = placed.groupBy(*by).applyInArrow(lambda key, group: run(key, group), schema(_PIECE))
    else:
        placed = stored(placed, "rotation-rows")
        tails = _group(cut, keys, _OPEN, _tail)
        tail = stored(placed.groupBy(*by).applyInArrow(lambda key, group: tails(key, group), schema(_OPEN)), "rotation-tails")
        following = shape.select(*by, F.col("__following")).where("__following IS NOT NULL")
        incoming = tail.join(following, by).select(*keys, F.col("__following").alias("__slice"), *[n for n, _ in _OPEN])
        pair = [("state", T.LongType()), ("after", T.LongType())]
        moves = _group(cut, keys, pair, _steps)
        steps = placed.groupBy(*by).cogroup(incoming.groupBy(*by)).applyInArrow(moves, schema(pair))
        steps = stored(steps.join(shape.select(*by, "k"), by).select(*keys, "k", "state", "after"), "rotation-steps")
        states = _reached(steps, keys, slices).where(F.col("state") != ANEW).join(shape.select(*by, "k"), [*keys, "k"])
        open_before = (states.select(*by, F.col("state").alias("at_row"))
                       .join(incoming, [*by, "at_row"]).select(*by, *[n for n, _ in _OPEN]))
        run = _group(cut, keys, _PIECE, _pieces)
        pieces = placed.groupBy(*by).cogroup(open_before.groupBy(*by)).applyInArrow(run, schema(_PIECE))
    merged = pieces.groupBy(*keys, "opened_us", "at_row").agg(
        F.max("last_us").alias("last_us"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    kept = [F.col(key.name)[key.name].alias(key.name) for key in key_types]
    return merged.select(*kept, "opened_us", "last_us", "rows", *(["bytes"] if size is not None else []))
