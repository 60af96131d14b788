"""Upbit: short keys, each with a long spelling that counts only if the short one is absent."""

from pyspark.sql import functions as F

from tickharbor.functions.documents import variant_integer, variant_string
from tickharbor.functions.scalars import ms_to_us
from tickharbor.venues import ORDERBOOK, TRADE, Payloads, Rule, venue
from tickharbor.venues.payloads import fill, level, mark, no_levels


_UNITS = ("array<struct<ap string, `as` string, bp string, bs string, "
          "ask_price string, ask_size string, bid_price string, bid_size string>>")


def levels(p):
    """Unit lists always replace the book."""
    units = F.coalesce(p["obu"], p["orderbook_units"])
    bids = F.transform(units, lambda u, i: level(F.lit("bid"), i, F.coalesce(u["bp"], u["bid_price"]), F.coalesce(u["bs"], u["bid_size"])))
    asks = F.transform(units, lambda u, i: level(F.lit("ask"), i, F.coalesce(u["ap"], u["ask_price"]), F.coalesce(u["as"], u["ask_size"])))
    return F.concat(mark(), F.coalesce(bids, no_levels()), F.coalesce(asks, no_levels()))


def totals(p):
    return F.coalesce(p["tas"], p["total_ask_size"]), F.coalesce(p["tbs"], p["total_bid_size"])


def fills(p):
    side = F.coalesce(p["ab"], p["ask_bid"])
    return F.array(fill(
        F.coalesce(p["sid"], p["sequential_id"]), F.coalesce(p["tp"], p["trade_price"]), F.coalesce(p["tv"], p["trade_volume"]),
        F.when(side == "ASK", "sell").when(side == "BID", "buy"), ms_to_us(F.coalesce(p["ttms"], p["trade_timestamp"]))))


@venue(
    "upbit",
    symbol=F.upper,
    channel=lambda native, book: F.when(book, "orderbook").otherwise("trade"),
    levels=Payloads("tas string, tbs string, total_ask_size string, total_bid_size string, "
                    f"obu {_UNITS}, orderbook_units {_UNITS}", levels),
    fills=Payloads("tp string, tv string, ab string, ttms bigint, sid string, trade_price string, trade_volume string, "
                   "ask_bid string, trade_timestamp bigint, sequential_id string", fills),
    totals=totals,
)
def rules(doc):
    frame_type = variant_string(doc.first_present("ty", "type"))
    symbol = F.coalesce(variant_string(doc.first_present("cd", "code")), F.lit("unknown"))
    book_time = doc.first_present("tms", "timestamp")
    trade_time = doc.first_present("ttms", "trade_timestamp")
    trade_id = doc.first_present("sid", "sequential_id", "ttms", "trade_timestamp")

    def text(value):
        return F.coalesce(F.to_json(value), F.lit("0"))

    return [
        Rule("book", frame_type == "orderbook", ORDERBOOK, symbol, text(book_time), ms_to_us(variant_integer(book_time))),
        Rule("trade", frame_type == "trade", TRADE, symbol, text(trade_id), ms_to_us(variant_integer(trade_time))),
    ]
