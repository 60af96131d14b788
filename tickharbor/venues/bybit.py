"""Bybit: the topic names the feed."""

from pyspark.sql import functions as F

from tickharbor.functions.scalars import ms_to_us
from tickharbor.venues import ORDERBOOK, OTHER, PONG, TRADE, Payloads, Rule, venue
from tickharbor.venues.payloads import PAIRS, fill, ladder, mark


def levels(p):
    whole = p["type"] == "snapshot"
    return F.concat(mark(whole), ladder(p["data"]["b"], "bid", snapshot=whole), ladder(p["data"]["a"], "ask", snapshot=whole))


def fills(p):
    return F.transform(p["data"], lambda t: fill(t["i"], t["p"], t["v"], t["S"], ms_to_us(t["T"])))


@venue(
    "bybit",
    symbol=lambda symbol: F.translate(F.upper(symbol), "-_/", ""),
    channel=lambda native, book: F.concat(F.when(book, "orderbook.50.").otherwise("publicTrade."), native),
    ping_seconds=20,
    levels=Payloads(f"type string, data struct<b {PAIRS}, a {PAIRS}>", levels),
    fills=Payloads("data array<struct<i string, p string, v string, S string, T bigint>>", fills),
)
def rules(doc):
    topic = doc.string("topic")
    unknown, zero = F.lit("unknown"), F.lit("0")

    return [
        Rule("reply", doc.has("success") | doc.has("ret_msg"), OTHER),
        Rule("book", topic.startswith("orderbook."), ORDERBOOK,
             F.coalesce(doc.string("data.s"), unknown),
             F.coalesce(doc.json("data.u"), doc.json("data.seq"), doc.json("ts"), zero),
             ms_to_us(doc.integer("ts"))),
        Rule("fills", topic.startswith("publicTrade."), TRADE,
             F.coalesce(doc.string("data[0].s"), unknown),
             F.coalesce(doc.string("data[0].i"), zero),
             ms_to_us(F.coalesce(doc.integer("data[0].T"), doc.integer("ts")))),
        Rule("pong", doc.string("op") == "pong", PONG),
    ]
