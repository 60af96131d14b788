"""Binance: depth snapshots, trades and aggregate trades."""

from pyspark.sql import functions as F

from tickharbor.functions.scalars import ms_to_us
from tickharbor.venues import ERROR, ORDERBOOK, OTHER, TRADE, Payloads, Rule, venue
from tickharbor.venues.payloads import PAIRS, fill, ladder, mark


def levels(p):
    """Depth frames always replace the book."""
    return F.concat(mark(), ladder(p["bids"], "bid"), ladder(p["asks"], "ask"))


def fills(p):
    def text(key):
        return F.try_variant_get(p, f"$.{key}", "string")

    buyer_is_maker = F.try_variant_get(p, "$.m", "boolean")
    taker = F.when(buyer_is_maker, "sell").when(~buyer_is_maker, "buy")
    trade_time = ms_to_us(F.try_variant_get(p, "$.T", "bigint"))
    return F.array(fill(F.coalesce(text("t"), text("a")), text("p"), text("q"), taker, trade_time))


@venue(
    "binance",
    symbol=F.lower,
    channel=lambda native, book: F.concat(native, F.when(book, "@depth20@100ms").otherwise("@trade")),
    levels=Payloads(f"bids {PAIRS}, asks {PAIRS}", levels),
    fills=Payloads("variant", fills),  # its keys t and T differ in case only, which a struct cannot tell apart
)
def rules(doc):
    symbol = F.coalesce(doc.string("s"), F.lit("unknown"))
    event_type = doc.string("e")
    event_time = ms_to_us(F.coalesce(doc.integer("E"), doc.integer("T")))

    def trade(name, kind, id_key):
        return Rule(name, event_type == kind, TRADE, symbol, F.coalesce(doc.json(id_key), F.lit("0")), event_time)

    return [
        Rule("acknowledgement", doc.has("result") | doc.has("id"), OTHER),
        Rule("venue error", doc.has("error"), ERROR,
             error=F.concat(F.lit("Binance error: "), doc.json("error"))),
        Rule("depth", doc.has("lastUpdateId"), ORDERBOOK, symbol, doc.json("lastUpdateId"), ms_to_us(doc.integer("E"))),
        trade("trade", "trade", "t"),
        trade("aggregate trade", "aggTrade", "a"),
    ]
