"""Levels, fills and the current book from literal payloads."""

from decimal import Decimal

from tickharbor.operators.payload import book_totals, current_book, explode_levels, explode_trades

SCHEMA = "exchange string, symbol string, data_type string, timestamp_collector long, timestamp_exchange long, data string, n long"


def events(spark, rows):
    return spark.createDataFrame([(e, "s", kind, ts, 0, data, i) for i, (e, kind, ts, data) in enumerate(rows)], SCHEMA)


def levels(spark, *rows):
    return [(r.exchange, r.snapshot, r.side, str(r.price.normalize()) if r.price is not None else None,
             str(r["size"].normalize()), r.orders) for r in
            explode_levels(events(spark, [(e, "orderbook", 1, d) for e, d in rows])).collect()]


def test_levels_of_every_shape(spark):
    assert levels(
        spark,
        ("binance", '{"bids":[["3.25","40"]],"asks":[["3.5","60"]]}'),
        ("coinbase", '{"type":"snapshot","bids":[["77","2.5"]],"asks":[]}'),
        ("coinbase", '{"type":"l2update","changes":[["buy","78","4.5"],["sell","79","0"]]}'),
        ("coinbase", '{"channel":"l2_data","events":[{"type":"snapshot","updates":[{"side":"bid","price_level":"55","new_quantity":"6"}]},{"type":"update"}]}'),
        ("okx", '{"action":"update","data":[{"asks":[["620","8","0","3"]],"bids":[["610","9","0","5"]]}]}'),
        ("bybit", '{"type":"delta","data":{"b":[["33","0.75"]],"a":[]}}'),
        ("upbit", '{"obu":[{"ap":7200,"as":0.9,"bp":7100,"bs":0.7}]}'),
        ("binance", '{"bids":[["no number","11"]]}'),
        ("binance", "{}"),
    ) == [
        ("binance", True, "bid", "3.25", "4E+1", None), ("binance", True, "ask", "3.5", "6E+1", None),
        ("coinbase", True, "bid", "77", "2.5", None),
        ("coinbase", False, "bid", "78", "4.5", None), ("coinbase", False, "ask", "79", "0", None),
        ("coinbase", True, "bid", "55", "6", None),
        ("okx", False, "bid", "6.1E+2", "9", 5), ("okx", False, "ask", "6.2E+2", "8", 3),
        ("bybit", False, "bid", "33", "0.75", None),
        ("upbit", True, "bid", "7.1E+3", "0.7", None), ("upbit", True, "ask", "7.2E+3", "0.9", None),
        ("binance", True, "bid", None, "11", None),
    ]


def test_fills_of_every_shape(spark):
    rows = explode_trades(events(spark, [(e, "trade", 1, d) for e, d in (
        ("binance", '{"e":"trade","E":11,"t":70001,"T":12,"p":"4.75","q":"30","m":true}'),
        ("binance", '{"e":"aggTrade","a":70002,"p":"4.5","q":"31","m":false}'),
        ("coinbase", '{"type":"match","trade_id":801,"time":"1970-01-01T00:00:07Z","size":"6.5","price":"912.5","side":"sell"}'),
        ("coinbase", '{"events":[{"trades":[{"trade_id":"802","price":"913","size":"14","side":"BUY"},{"trade_id":"803","price":"914","size":"15","side":"SELL"}]}]}'),
        ("okx", '{"data":[{"tradeId":"901","px":"21","sz":"22","side":"buy","ts":"23"},{"tradeId":"902","px":"24","sz":"25","side":"sell","ts":"26"}]}'),
        ("bybit", '{"data":[{"i":"fill-1","T":41,"p":"42","v":"43","S":"Buy","s":"X"}]}'),
        ("upbit", '{"tp":66000,"tv":0.5,"ab":"BID","ttms":51,"sid":60001}'),
    )])).collect()
    assert [(r.exchange, r.trade_id, r.price, r["size"], r.side, r.trade_time_us) for r in rows] == [
        ("binance", "70001", Decimal("4.75"), 30, "sell", 12_000), ("binance", "70002", Decimal("4.5"), 31, "buy", 0),
        ("coinbase", "801", Decimal("912.5"), Decimal("6.5"), "sell", 7_000_000),
        ("coinbase", "802", 913, 14, "buy", 0), ("coinbase", "803", 914, 15, "sell", 0),
        ("okx", "901", 21, 22, "buy", 23_000), ("okx", "902", 24, 25, "sell", 26_000),
        ("bybit", "fill-1", 42, 43, "buy", 41_000), ("upbit", "60001", 66_000, Decimal("0.5"), "buy", 51_000)]


def test_totals(spark):
    rows = book_totals(events(spark, [("upbit", "orderbook", 1, '{"tas":8.75,"tbs":"16"}'), ("okx", "orderbook", 1, "{}")])).collect()
    assert [(r.total_ask_size, r.total_bid_size) for r in rows] == [(Decimal("8.75"), 16)]


def book(spark, *messages):
    rows = current_book(events(spark, [(e, "orderbook", at, data) for e, at, data in messages]), "n").collect()
    return {(r.exchange, int(r.price), int(r["size"]), r.updated_us) for r in rows}


def test_the_book_starts_at_the_latest_snapshot_and_size_0_removes(spark):
    def message(kind, bids):
        return f'{{"type":"{kind}","data":{{"b":{bids},"a":[]}}}}'

    assert book(
        spark, ("bybit", 1, message("delta", '[["1","9"],["8","8"]]')), ("bybit", 2, message("snapshot", '[["1","5"],["2","5"]]')),
        ("bybit", 3, message("delta", '[["2","0"],["3","1"]]')), ("bybit", 4, message("delta", '[["3","2"]]')),
    ) == {("bybit", 1, 5, 2), ("bybit", 3, 2, 4)}


def test_parts_of_a_frame_count_in_order(spark):
    def event(kind, *updates):
        listed = ",".join(f'{{"side":"bid","price_level":"{p}","new_quantity":"{q}"}}' for p, q in updates)
        return f'{{"type":"{kind}","updates":[{listed}]}}'

    def frame(*parts):
        return f'{{"channel":"l2_data","events":[{",".join(parts)}]}}'

    assert book(spark, ("coinbase", 1, frame(event("snapshot", (17, 4), (18, 6)), event("update", (19, 1), (17, 9))))) == {
        ("coinbase", 17, 9, 1), ("coinbase", 18, 6, 1), ("coinbase", 19, 1, 1)}
    assert book(spark, ("coinbase", 1, frame(event("update", (17, 4)), event("snapshot", (18, 6))))) == {("coinbase", 18, 6, 1)}
    assert book(spark, ("okx", 1, '{"action":"update","data":[{"bids":[["17","4"]]},{"bids":[["16","1"],["17","8"]]}]}')) == {
        ("okx", 16, 1, 1), ("okx", 17, 8, 1)}


def test_a_snapshot_without_levels_empties_the_book(spark):
    for venue, first, second in (
        ("bybit", '{"type":"delta","data":{"b":[["17","4"]],"a":[]}}', '{"type":"snapshot","data":{"b":[],"a":[]}}'),
        ("coinbase", '{"type":"l2update","changes":[["buy","17","4"]]}', '{"channel":"l2_data","events":[{"type":"snapshot","updates":[]}]}'),
        ("okx", '{"action":"update","data":[{"bids":[["17","4"]]}]}', '{"action":"snapshot","data":[{"bids":[],"asks":[]}]}'),
        ("binance", '{"bids":[["17","4"]],"asks":[]}', '{"bids":[],"asks":[]}'),
    ):
        assert book(spark, (venue, 1, first)) == {(venue, 17, 4, 1)}
        assert book(spark, (venue, 1, first), (venue, 2, second)) == set()
