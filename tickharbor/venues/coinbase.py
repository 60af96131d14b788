"""Coinbase: the channel format, and the older format that has only a type."""

from pyspark.sql import functions as F

from tickharbor.functions.scalars import iso8601_to_us
from tickharbor.venues import ORDERBOOK, OTHER, TRADE, Payloads, Rule, venue
from tickharbor.venues.payloads import PAIRS, book_side, fill, ladder, level, mark, no_levels


_BOOK = (f"type string, bids {PAIRS}, asks {PAIRS}, changes {PAIRS}, "
         "events array<struct<type string, updates array<struct<side string, price_level string, new_quantity string>>>>")
_TRADE = ("trade_id string, price string, size string, side string, time string, "
          "events array<struct<trades array<struct<trade_id string, price string, size string, side string, time string>>>>")


def levels(p):
    whole = p["type"] == "snapshot"
    changes = F.transform(p["changes"], lambda c, i: level(
        book_side(F.get(c, F.lit(0))), i, F.get(c, F.lit(1)), F.get(c, F.lit(2)), snapshot=whole))
    updates = F.flatten(F.transform(p["events"], lambda e, n: F.concat(
        mark(e["type"] == "snapshot", n), F.coalesce(F.transform(e["updates"], lambda u, i: level(
            book_side(u["side"]), i, u["price_level"], u["new_quantity"], None, n, e["type"] == "snapshot")), no_levels()))))
    return F.concat(mark(whole), ladder(p["bids"], "bid", snapshot=whole), ladder(p["asks"], "ask", snapshot=whole),
                    F.coalesce(changes, no_levels()), F.coalesce(updates, no_levels()))


def fills(p):
    nested = F.flatten(F.transform(p["events"], lambda e: F.transform(e["trades"], lambda t: fill(
        t["trade_id"], t["price"], t["size"], t["side"], iso8601_to_us(t["time"])))))
    return F.when(p["events"].isNotNull(), nested).otherwise(
        F.array(fill(p["trade_id"], p["price"], p["size"], p["side"], iso8601_to_us(p["time"]))))


@venue(
    "coinbase",
    symbol=F.upper,
    channel=lambda native, book: F.when(book, "level2").otherwise("market_trades"),
    ping_seconds=20,
    levels=Payloads(_BOOK, levels),
    fills=Payloads(_TRADE, fills),
)
def rules(doc):
    unknown, zero = F.lit("unknown"), F.lit("0")
    channel = F.coalesce(doc.string("channel"), F.lit(""))
    old_type = F.coalesce(doc.string("type"), unknown)
    first_fill = "events[0].trades[0]"

    product, time = doc.string("product_id"), doc.string("time")
    old_fields = {"symbol": F.coalesce(product, unknown), "time_us": iso8601_to_us(time)}

    return [
        Rule("level2 channel", channel == "l2_data", ORDERBOOK,
             F.coalesce(doc.string("events[0].product_id"), unknown),
             F.coalesce(doc.unsigned_text("sequence_num"), zero),
             iso8601_to_us(doc.string("timestamp"))),
        Rule("trades channel", channel == "market_trades", TRADE,
             F.coalesce(doc.string(f"{first_fill}.product_id"), unknown),
             F.coalesce(doc.string(f"{first_fill}.trade_id"), zero),
             iso8601_to_us(doc.string(f"{first_fill}.time"))),
        Rule("other channel", channel != "", OTHER),
        Rule("snapshot or update", old_type.isin("snapshot", "l2update"), ORDERBOOK,
             sequence=F.coalesce(time, zero), **old_fields),
        Rule("match", old_type.isin("match", "last_match"), TRADE,
             sequence=F.coalesce(doc.json("sequence"), doc.json("trade_id"), zero), **old_fields),
    ]
