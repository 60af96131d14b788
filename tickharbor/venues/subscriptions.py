"""What to ask a venue for, and how it spells a symbol."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickharbor.functions.scalars import ColumnOrName
from tickharbor.venues import VENUES


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _by_venue(exchange: ColumnOrName, value) -> Column:
    """``value`` of the row's venue, whose name may come in any case; NULL for an unknown one."""
    name = F.lower(_col(exchange))
    return F.coalesce(F.lit(None).cast("string"), *[F.when(name == key, value(one)) for key, one in VENUES.items()])


def api_symbol(exchange: ColumnOrName, symbol: ColumnOrName) -> Column:
    """The form of a symbol that a venue's own interface expects."""
    return _by_venue(exchange, lambda one: one.symbol(_col(symbol)))


def stream_channel(exchange: ColumnOrName, symbol: ColumnOrName, feed: ColumnOrName) -> Column:
    """The stream, topic or channel that a venue serves a canonical feed under.

    Some venues put the symbol into the name; the others take it as a separate argument.
    """
    book = _col(feed) == "orderbook"
    return _by_venue(exchange, lambda one: one.channel(one.symbol(_col(symbol)), book))
