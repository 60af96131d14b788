"""Everything the library knows of each trading venue, one module a venue.

A :class:`Venue` carries the rules of its frames, the form of its symbols, its channels, its ping and the shapes of its
payloads; parsing, subscription plans, validation, sessions, levels and fills all read it from ``VENUES``. A new venue
is one module that calls :func:`venue`, and nothing else changes. Rules are an ordered list of :class:`Rule`; the first
one whose condition holds decides about a frame. The key, channel and type names in these modules are fixed values of
the venues' own formats, and the defaults "unknown" and "0" are fixed values of the stored table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from tickharbor.functions.documents import Document

ORDERBOOK, TRADE, PONG, OTHER, ERROR = "orderbook", "trade", "pong", "other", "error"


@dataclass(frozen=True)
class Rule:
    """What one kind of frame looks like and where its fields are."""

    name: str
    when: Column
    kind: str
    symbol: Column | None = None
    sequence: Column | None = None
    time_us: Column | None = None
    error: Column | None = None
    notice_code: Column | None = None
    notice_message: Column | None = None


@dataclass(frozen=True)
class Payloads:
    """How one kind of stored payload is opened: the type that ``from_json`` reads, and its rows from a parsed payload."""

    shape: str
    rows: Callable[[Column], Column]


@dataclass(frozen=True)
class Venue:
    """One venue. ``rules`` takes a :class:`~tickharbor.functions.documents.Document`."""

    name: str
    rules: Callable[[Document], list[Rule]]
    # The symbol as the venue spells it, and the channel of a feed from that symbol and whether it is the book's.
    symbol: Callable[[Column], Column]
    channel: Callable[[Column, Column], Column]
    # Frames that are plain text and not JSON, with their kind; they are recognised before JSON is looked at.
    plain_text: dict[str, str] = field(default_factory=dict)
    # Seconds between pings that the venue expects, if any.
    ping_seconds: int | None = None
    # Levels of book payloads, fills of trade payloads, and total (ask, bid) sizes where the venue states them.
    levels: Payloads | None = None
    fills: Payloads | None = None
    totals: Callable[[Column], tuple[Column, Column]] | None = None


VENUES: dict[str, Venue] = {}


def venue(name: str, **parts):
    """Register the decorated rules under a name, in lower case, with the other parts of a :class:`Venue`."""
    def add(rules: Callable[[Document], list[Rule]]):
        VENUES[name] = Venue(name, rules, **parts)
        return rules

    return add


from tickharbor.venues import binance, bybit, coinbase, okx, upbit  # noqa: E402,F401
