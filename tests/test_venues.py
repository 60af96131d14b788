"""A sixth venue, stated here alone, goes through everything that a venue takes part in."""

import pytest
from pyspark.sql import functions as F

from tickharbor.functions.scalars import ms_to_us
from tickharbor.operators import payload, quality
from tickharbor.operators.parsing import market_events, parse_frames
from tickharbor.sources import config as C
from tickharbor.venues import ORDERBOOK, OTHER, PONG, TRADE, VENUES, Payloads, Rule, venue
from tickharbor.venues.payloads import PAIRS, fill, ladder, mark

US = 1_704_067_200_000_000
FRAMES = [
    ("orderbook", 0, '{"what":"book","pair":"BTC|USD","n":7,"at":1704067200000,"whole":true,"b":[["100","1"],["99","2"]],"a":[["101","3"]],"sum":["3","3"]}'),
    ("orderbook", 1, '{"what":"book","pair":"BTC|USD","n":8,"at":1704067201000,"whole":false,"b":[["100","0"]],"a":[]}'),
    ("orderbook", 2, "tock"),
    ("trades", 3, '{"what":"deals","pair":"BTC|USD","at":1704067203000,"deals":[{"id":"d1","p":"100.5","q":"2","up":true},{"id":"d2","p":"100","q":"1","up":false}]}'),
    ("trades", 4, '{"what":"hello"}'),
    ("orderbook", 300, '{"what":"book","pair":"BTC|USD","n":9,"at":1704067500000,"whole":false,"b":[],"a":[["102","4"]]}'),
]


@pytest.fixture
def sixth():
    @venue(
        "gamma",
        symbol=lambda symbol: F.replace(F.upper(symbol), F.lit("-"), F.lit("|")),
        channel=lambda native, book: F.concat(F.when(book, "book/").otherwise("deals/"), native),
        plain_text={"tock": PONG},
        ping_seconds=60,
        levels=Payloads(f"whole boolean, b {PAIRS}, a {PAIRS}, sum array<string>", lambda p: F.concat(
            mark(p["whole"]), ladder(p["b"], "bid", snapshot=p["whole"]), ladder(p["a"], "ask", snapshot=p["whole"]))),
        fills=Payloads("at bigint, deals array<struct<id string, p string, q string, up boolean>>", lambda p: F.transform(
            p["deals"], lambda d: fill(d["id"], d["p"], d["q"], F.when(d["up"], "buy").otherwise("sell"), ms_to_us(p["at"])))),
        totals=lambda p: (F.get(p["sum"], F.lit(0)), F.get(p["sum"], F.lit(1))),
    )
    def rules(doc):
        what, pair, at = doc.string("what"), doc.string("pair"), ms_to_us(doc.integer("at"))
        return [
            Rule("book", what == "book", ORDERBOOK, pair, doc.json("n"), at),
            Rule("deals", what == "deals", TRADE, pair, doc.string("deals[0].id"), at),
            Rule("greeting", what == "hello", OTHER),
        ]

    yield "gamma"
    del VENUES["gamma"]


@pytest.fixture
def frames(spark):
    return spark.createDataFrame(
        [("Gamma", "btc-usd", feed, US + s * 1_000_000, text) for feed, s, text in FRAMES],
        "exchange string, native_symbol string, feed string, timestamp_collector long, frame string").coalesce(1)


def test_parse_levels_fills_totals_and_book(spark, sixth, frames):
    parsed = parse_frames(frames)
    kinds = [(r.kind, r.sequence_id) for r in parsed.orderBy("timestamp_collector").collect()]
    assert kinds == [("orderbook", "7"), ("orderbook", "8"), ("pong", None), ("trade", "d1"), ("other", None), ("orderbook", "9")]
    events = market_events(parsed)
    assert {(r.exchange, r.symbol) for r in events.collect()} == {("gamma", "btcusd")}
    levels = payload.explode_levels(events)
    assert [(r.side, float(r.price), float(r.size), r.snapshot) for r in levels.orderBy("timestamp_collector", F.desc("side"), "position").collect()] == [
        ("bid", 100, 1, True), ("bid", 99, 2, True), ("ask", 101, 3, True), ("bid", 100, 0, False), ("ask", 102, 4, False)]
    fills = payload.explode_trades(events).orderBy("trade_id").collect()
    assert [(r.trade_id, float(r.price), r.side, r.trade_time_us) for r in fills] == [
        ("d1", 100.5, "buy", US + 3_000_000), ("d2", 100, "sell", US + 3_000_000)]
    totals = payload.book_totals(events).where("total_ask_size IS NOT NULL").collect()
    assert [(float(r.total_ask_size), float(r.total_bid_size)) for r in totals] == [(3, 3)]
    book = {(r.side, float(r.price)) for r in payload.current_book(events, "exchange_sequence_id").collect()}
    assert book == {("bid", 99), ("ask", 101), ("ask", 102)}


def test_sessions_follow_the_venue_s_ping(spark, sixth, frames):
    assert quality.sessions(parse_frames(frames).where("feed = 'orderbook'"), "frame").count() == 2
    limit = spark.range(1).select(quality.dead_after_us(F.lit("gamma")), quality.dead_after_us(F.lit("binance"))).first()
    assert limit[0] == 120_000_000 and limit[1] == quality.DEAD_CONNECTION_SECONDS * 1_000_000


def test_subscriptions_and_validation(spark, sixth):
    config = C.read_market_config(spark, '[[markets]]\nexchange = "Gamma"\nsymbols = ["btc-usd"]\n')
    plan = C.subscription_plan(C.market_streams(config)).collect()
    assert {(r.channel, r.instrument) for r in plan} == {("book/BTC|USD", "BTC|USD"), ("deals/BTC|USD", "BTC|USD")}
    assert C.unsupported_markets(config).count() == 0


def test_without_the_module_the_venue_is_unknown(spark, frames):
    assert {r.kind for r in parse_frames(frames).collect()} == {"error"}
    config = C.read_market_config(spark, '[[markets]]\nexchange = "gamma"\nsymbols = ["btc-usd"]\n')
    assert C.unsupported_markets(config).count() == 1
