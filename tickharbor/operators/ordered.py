"""Ordered state within a key that may hold any share of the rows.

A window over ``PARTITION BY key`` puts a whole key into one task. That is the best
plan while every key is small, and no plan at all once a single symbol holds a third
of the archive. ``with_previous`` measures the largest key first. Beyond the bound it
cuts the rows into range partitions over (key, order), keeps those cuts as a column of a
table in the shared folder, runs the window inside each slice, and carries the state of
earlier slices of the same key in through a table of one row per (slice, key).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickharbor.session import stored

# Rows of one key that a single task may sort; override per session.
HOT_ROWS_SETTING = "spark.tickharbor.hotKeyRows"
HOT_ROWS_DEFAULT = 5_000_000


@dataclass(frozen=True)
class Previous:
    """State of the rows before this one in its key: ``last`` non-null value, ``max``, or
    running ``sum`` (which includes this row)."""

    kind: str
    column: str


def hot_rows_bound(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS_DEFAULT)))


def key_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest key and rows in total, by one pass over the key columns."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return largest or 0, total or 0


def _over(kind: str, column: Column, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    if kind == "max":
        return F.max(column).over(before)
    if kind == "last":
        return F.last(column, ignorenulls=True).over(before)
    if kind == "sum":
        return F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    raise ValueError(f"unknown state {kind}")


def _slice_state(state: Previous, order: list[str]) -> Column:
    """What a slice hands on to the later slices of its key."""
    column = F.col(state.column)
    if state.kind == "last":
        return F.max_by(column, F.when(column.isNotNull(), F.struct(*order)))
    return F.max(column) if state.kind == "max" else F.sum(column)


def _combine(kind: str, local: Column, carried: Column) -> Column:
    if kind == "max":
        return F.greatest(local, carried)
    if kind == "last":
        return F.coalesce(local, carried)
    return F.coalesce(local + carried, local, carried)


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], states: dict[str, Previous],
    hot_rows: int | None = None, sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Add one column per state. ``order`` should be a total order within a key.

    ``sizes`` is the result of :func:`key_sizes` where the caller already has it.
    """
    bound = hot_rows_bound(df) if hot_rows is None else hot_rows
    largest, total = sizes or key_sizes(df, keys)
    if largest <= bound:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[_over(s.kind, F.col(s.column), window).alias(name) for name, s in states.items()])

    # As many as the bound asks for: a slice must not grow with the table.
    slices = max(2, total // max(bound // 4, 1) + 1)
    sliced = stored(df.repartitionByRange(slices, *keys, *order).withColumn("__slice", F.spark_partition_id()), "slices")

    within = Window.partitionBy("__slice", *keys).orderBy(*order)
    local = sliced.select("*", *[_over(s.kind, F.col(s.column), within).alias(name) for name, s in states.items()])

    handed_on = sliced.groupBy("__slice", *keys).agg(*[_slice_state(s, order).alias(name) for name, s in states.items()])
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    gather = {"max": F.max, "sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True)}
    carried = handed_on.select(
        F.col("__slice").alias("__carried_slice"),
        *[F.col(key).alias(f"__carried_{key}") for key in keys],
        *[gather[s.kind](F.col(name)).over(earlier).alias(f"__carried_{name}") for name, s in states.items()],
    )
    same = reduce(
        lambda left, right: left & right,
        [F.col(key).eqNullSafe(F.col(f"__carried_{key}")) for key in keys],
        F.col("__slice") == F.col("__carried_slice"),
    )
    return local.join(carried, same, "left").select(
        *df.columns,
        *[_combine(s.kind, F.col(name), F.col(f"__carried_{name}")).alias(name) for name, s in states.items()],
    )
