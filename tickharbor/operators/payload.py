"""Opening the stored payloads into order-book levels, fills and the current book.

The payload shapes differ by venue and by message. Each shape has a schema that
``from_json`` reads; levels and fills of all shapes, as the venues' modules state them,
are normalised in one CASE and exploded. Nothing leaves the JVM and no row list is
ever collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickharbor.schemas import WRITER_KEY
from tickharbor.session import stored
from tickharbor.venues import VENUES, Payloads
from tickharbor.venues.payloads import FILL, LEVEL

AMOUNT = "decimal(38,18)"


def _opened(rows: DataFrame, payloads: dict[str, Payloads], keep: list[str], made: Callable[[str, Column], Column]) -> tuple[DataFrame, Column]:
    """Rows with one parsed payload column per venue, NULL for rows of other venues, and ``made`` of the row's own.

    A column of its own, because every field taken from a ``from_json`` inside a larger
    expression would parse the payload again.
    """
    parsed = rows.select(*keep, *[
        F.when(F.col("exchange") == name, F.from_json("data", one.shape)).alias(f"__{name}") for name, one in payloads.items()])
    chain = F
    for name in payloads:
        chain = chain.when(F.col("exchange") == name, made(name, F.col(f"__{name}")))
    return parsed, chain


def _levels_and_marks(events: DataFrame, *keep: str) -> DataFrame:
    head = [*keep, *WRITER_KEY[:2], "timestamp_collector", "timestamp_exchange"]
    known = {name: one.levels for name, one in VENUES.items() if one.levels}
    books, levels = _opened(events.where(F.col("data_type") == "orderbook"), known, head, lambda name, p: known[name].rows(p).cast(LEVEL))
    return books.select(*head, F.inline(levels)).select(
        *head, "part", "snapshot", "side", "position",
        F.col("price").try_cast(AMOUNT).alias("price"), F.col("size").try_cast(AMOUNT).alias("size"),
        F.col("orders").try_cast("bigint").alias("orders"))


def explode_levels(events: DataFrame, *keep: str) -> DataFrame:
    """One row per price level of every order-book message, in order of ``part`` and ``position`` within it."""
    return _levels_and_marks(events, *keep).where(F.col("position") >= 0)


def explode_trades(events: DataFrame, *keep: str) -> DataFrame:
    """One row per fill of every trade message."""
    head = [*keep, *WRITER_KEY[:2], "timestamp_collector"]
    known = {name: one.fills for name, one in VENUES.items() if one.fills}
    trades, fills = _opened(events.where(F.col("data_type") == "trade"), known, head, lambda name, p: known[name].rows(p).cast(FILL))
    return trades.select(*head, F.inline(fills)).select(
        *head, "trade_id",
        F.col("price").try_cast(AMOUNT).alias("price"), F.col("size").try_cast(AMOUNT).alias("size"),
        "side", "trade_time_us")


def book_totals(events: DataFrame, *keep: str) -> DataFrame:
    """The total ask and bid size, of venues that state them with their levels."""
    head = [*keep, *WRITER_KEY[:2], "timestamp_collector"]
    known = {name: one.levels for name, one in VENUES.items() if one.levels and one.totals}
    rows = events.where((F.col("data_type") == "orderbook") & F.col("exchange").isin(*known))

    def stated(name: str, p: Column) -> Column:
        return F.struct(*[size.try_cast(AMOUNT).alias(side) for side, size in zip(("total_ask_size", "total_bid_size"), VENUES[name].totals(p))])

    books, totals = _opened(rows, known, head, stated)
    return books.select(*head, totals.alias("__totals")).select(*head, "__totals.*")


def current_book(events: DataFrame, tiebreak: str, at_us: int | None = None) -> DataFrame:
    """The book per symbol: the last size at each price since the latest snapshot; size 0 removes.

    The payloads are opened once. One aggregation keeps the last size of each price level, on
    the map side first, however hot a symbol or level is; the mark of a snapshot is kept like
    a level, so one without levels empties the book too. A level whose last size is older
    than the symbol's latest snapshot is no longer in the book. A symbol without a snapshot
    starts from its first update. Parts of a frame count one after another.
    """
    keys = WRITER_KEY[:2]
    seen = events if at_us is None else events.where(F.col("timestamp_collector") <= at_us)
    moment = F.struct("timestamp_collector", tiebreak, "part")
    order = F.struct("timestamp_collector", tiebreak, "part", "position")
    last = stored(_levels_and_marks(seen, tiebreak).groupBy(*keys, "side", "price").agg(
        F.max_by("size", order).alias("size"), F.max(moment).alias("__updated"),
        F.max(F.when(F.col("position") < 0, moment)).alias("__snapshot")), "levels")
    start = last.groupBy(*keys).agg(F.max("__snapshot").alias("__start"))
    current = last.join(start, keys).where(F.col("__start").isNull() | (F.col("__updated") >= F.col("__start")))
    return current.where(F.col("size") > 0).select(
        *keys, "side", "price", "size", F.col("__updated.timestamp_collector").alias("updated_us"))


def book_state(events: DataFrame, tiebreak: str, before: DataFrame | None = None) -> DataFrame:
    """What a book needs to go on: the newest row of each level and of the snapshot marks, with its place in order.

    ``before`` is the state that earlier frames have left; only it and ``events`` are read. Frames may come in any
    order, also later than newer ones: the newest row of a level wins, a level whose size is 0 stays as such, and
    what is older than its symbol's latest snapshot is left out for good. Advancing in steps gives the same as one
    pass over all frames. Read the book itself with :func:`book_of`.
    """
    keys = WRITER_KEY[:2]
    rows = _levels_and_marks(events, tiebreak).select(
        *keys, "side", "price", "size", (F.col("position") < 0).alias("mark"), "timestamp_collector", tiebreak, "part", "position")
    order = F.struct("timestamp_collector", tiebreak, "part", "position")
    newest = (rows if before is None else rows.unionByName(before)).groupBy(*keys, "side", "price", "mark").agg(
        F.max_by("size", order).alias("size"), F.max(order).alias("__order"))
    level = stored(newest.select(*keys, "side", "price", "size", "mark", "__order.*"), "book-levels")
    moment = F.struct("timestamp_collector", tiebreak, "part")
    start = level.where("mark").groupBy(*keys).agg(F.max(moment).alias("__start"))
    return level.join(start, keys, "left").where(F.col("__start").isNull() | (moment >= F.col("__start"))).drop("__start")


def book_of(state: DataFrame) -> DataFrame:
    """The book that a state holds, as :func:`current_book` gives it."""
    return state.where("NOT mark AND size > 0").select(
        *WRITER_KEY[:2], "side", "price", "size", F.col("timestamp_collector").alias("updated_us"))
