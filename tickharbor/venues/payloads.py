"""Building blocks for a venue's levels and fills, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = "array<array<string>>"
# ``part`` numbers the events or elements of one frame, which may each replace the book. A part that
# replaces the book has a mark: a level without side, price and size, at position -1.
LEVEL = "array<struct<part int, snapshot boolean, side string, position int, price string, size string, orders string>>"
FILL = "array<struct<trade_id string, price string, size string, side string, trade_time_us bigint>>"


def no_levels() -> Column:
    return F.array().cast(LEVEL)


def level(side, position, price, size, orders=None, part=None, snapshot=None) -> Column:
    return F.struct(
        (F.lit(0) if part is None else part.cast("int")).alias("part"),
        (F.lit(True) if snapshot is None else F.coalesce(snapshot, F.lit(False))).alias("snapshot"), side.alias("side"), position.cast("int").alias("position"), price.alias("price"), size.alias("size"),
        (F.lit(None).cast("string") if orders is None else orders).alias("orders"))


def ladder(levels: Column, side: str, orders: bool = False, part: Column | None = None, snapshot: Column | None = None) -> Column:
    """A list of [price, size, ...] to levels; a missing list is empty."""
    opened = F.transform(levels, lambda row, i: level(
        F.lit(side), i, F.get(row, F.lit(0)), F.get(row, F.lit(1)), F.get(row, F.lit(3)) if orders else None, part, snapshot))
    return F.coalesce(opened, no_levels())


def mark(snapshot: Column | None = None, part: Column | None = None) -> Column:
    """The mark of a part that replaces the book; nothing for one that does not."""
    nothing = F.lit(None).cast("string")
    found = F.array(level(nothing, F.lit(-1), nothing, nothing, None, part, None)).cast(LEVEL)
    return found if snapshot is None else F.when(F.coalesce(snapshot, F.lit(False)), found).otherwise(no_levels())


def book_side(word: Column) -> Column:
    """Venue words for a side of the book."""
    lowered = F.lower(word)
    return F.when(lowered.isin("bid", "buy"), "bid").when(lowered.isin("ask", "sell", "offer"), "ask")


def fill(trade_id, price, size, side, time_us) -> Column:
    return F.struct(trade_id.alias("trade_id"), price.alias("price"), size.alias("size"),
                    F.lower(side).alias("side"), time_us.alias("trade_time_us"))
