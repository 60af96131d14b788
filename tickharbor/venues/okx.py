"""OKX: channels named in ``arg``, rows in ``data``; answers a ping with the bare text pong."""

from pyspark.sql import functions as F

from tickharbor.functions.scalars import text_ms_to_us
from tickharbor.venues import ORDERBOOK, OTHER, PONG, TRADE, Payloads, Rule, venue
from tickharbor.venues.payloads import PAIRS, fill, ladder, mark


def levels(p):
    whole = p["action"] == "snapshot"
    return F.coalesce(F.flatten(F.transform(p["data"], lambda d, n: F.concat(
        mark(whole, n), ladder(d["bids"], "bid", True, n, whole), ladder(d["asks"], "ask", True, n, whole)))), mark(whole))


def fills(p):
    return F.transform(p["data"], lambda t: fill(t["tradeId"], t["px"], t["sz"], t["side"], text_ms_to_us(t["ts"])))


@venue(
    "okx",
    symbol=F.upper,
    channel=lambda native, book: F.when(book, "books").otherwise("trades"),
    plain_text={"pong": PONG},
    ping_seconds=15,
    levels=Payloads(f"action string, data array<struct<bids {PAIRS}, asks {PAIRS}>>", levels),
    fills=Payloads("data array<struct<tradeId string, px string, sz string, side string, ts string>>", fills),
)
def rules(doc):
    event = doc.string("event")
    is_notice = event == "notice"
    channel = doc.string("arg.channel")
    instrument = F.coalesce(doc.string("arg.instId"), F.lit("unknown"))
    time = doc.string("data[0].ts")

    return [
        Rule("event", event.isNotNull(), OTHER,
             notice_code=F.when(is_notice, F.coalesce(doc.string("code"), F.lit("unknown"))),
             notice_message=F.when(is_notice, F.coalesce(doc.string("msg"), F.lit("")))),
        Rule("books", channel.startswith("books"), ORDERBOOK, instrument,
             F.coalesce(doc.json("data[0].seqId"), time, F.lit("0")), text_ms_to_us(time)),
        Rule("trades", channel == "trades", TRADE, instrument,
             F.coalesce(doc.string("data[0].tradeId"), F.lit("0")), text_ms_to_us(time)),
    ]
