"""Golden frames, and frames for every rule and default."""

import re
from pathlib import Path

import pytest

from tickharbor.operators.parsing import PARSED_COLUMNS, data_rows, dead_letters, market_events, parse_frames
from tickharbor.schemas import MARKET_EVENT

FIXTURES = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text().splitlines()


def golden():
    frames = dict(line.split(" ", 1) for line in FIXTURES if re.match(r"G\d+ \{", line))
    cases = []
    for line in FIXTURES:
        cells = [cell.strip() for cell in line.strip("|").split("|")]
        if re.fullmatch(r"G\d+", cells[0]):
            cases.append((cells[1], frames[cells[0]], cells[2], cells[3], cells[4], int(cells[5])))
    return cases


# venue, frame, kind, symbol, sequence, time
EDGES = [
    ("binance", '{"result":null,"id":1}', "other", None, None, None),
    ("binance", '{"result":null}', "other", None, None, None),
    ("binance", '{"id":3,"error":{"code":2}}', "other", None, None, None),
    ("binance", '{"error":{"code":2}}', "error", None, None, None),
    ("binance", '{"lastUpdateId":160,"bids":[],"asks":[]}', "orderbook", "unknown", "160", 0),
    ("binance", '{"lastUpdateId":null,"s":"X","E":1.5}', "orderbook", "X", "null", 0),
    ("binance", '{"e":"aggTrade","a":7,"T":5}', "trade", "unknown", "7", 5000),
    ("binance", '{"e":"trade","t":"9","E":"5"}', "trade", "unknown", '"9"', 0),
    ("binance", '{"e":"trade","E":"5","T":6}', "trade", "unknown", "0", 6000),
    ("binance", '{"e":"trade","t":1,"t":2,"E":9223372036854775807}', "trade", "unknown", "2", 0),
    ("binance", '{"e":"kline"}', "other", None, None, None),
    ("binance", "[1,2]", "other", None, None, None),
    ("binance", "pong", "error", None, None, None),
    ("okx", "pong", "pong", None, None, None),
    ("okx", '"pong"', "other", None, None, None),
    ("okx", '{"arg":{"channel":"trades","instId":"X-Y"},"data":[{"tradeId":5}]}', "trade", "X-Y", "0", 0),
    ("okx", '{"arg":{"channel":"books5"},"data":[{"ts":"12"}]}', "orderbook", "unknown", "12", 12000),
    ("okx", '{"arg":{"channel":"books"},"data":[{"seqId":-1,"ts":" 12"}]}', "orderbook", "unknown", "-1", 0),
    ("okx", '{"arg":{"channel":"books","instId":"A"},"data":[]}', "orderbook", "A", "0", 0),
    ("okx", '{"event":5,"arg":{"channel":"tickers"}}', "other", None, None, None),
    ("bybit", '{"op":"pong"}', "pong", None, None, None),
    ("bybit", '{"success":true,"ret_msg":"pong","op":"ping"}', "other", None, None, None),
    ("bybit", '{"topic":"orderbook.1.X","ts":7,"data":{"seq":4}}', "orderbook", "unknown", "4", 7000),
    ("bybit", '{"topic":"orderbook.1.X","ts":7}', "orderbook", "unknown", "7", 7000),
    ("bybit", '{"topic":"publicTrade.X","ts":7,"data":[{"i":5,"T":"8"}]}', "trade", "unknown", "0", 7000),
    ("bybit", '{"topic":"kline"}', "other", None, None, None),
    ("coinbase", '{"channel":"l2_data","events":[]}', "orderbook", "unknown", "0", 0),
    ("coinbase", '{"channel":"l2_data","sequence_num":18446744073709551615}', "orderbook", "unknown", "18446744073709551615", 0),
    ("coinbase", '{"channel":"l2_data","sequence_num":-1,"timestamp":"2023-01-01"}', "orderbook", "unknown", "0", 0),
    ("coinbase", '{"channel":"l2_data","sequence_num":5.0}', "orderbook", "unknown", "0", 0),
    ("coinbase", '{"channel":"market_trades","events":[{"trades":[{"trade_id":5,"time":"2023-01-01T00:00:00+01:00"}]}]}',
     "trade", "unknown", "0", 1672527600000000),
    ("coinbase", '{"channel":"heartbeats","type":"match"}', "other", None, None, None),
    ("coinbase", '{"type":"l2update","product_id":"A-B"}', "orderbook", "A-B", "0", 0),
    ("coinbase", '{"type":"last_match","trade_id":10,"sequence":null}', "trade", "unknown", "null", 0),
    ("coinbase", '{"type":"last_match","trade_id":10}', "trade", "unknown", "10", 0),
    ("coinbase", '{"type":"error"}', "other", None, None, None),
    ("upbit", '{"type":"orderbook","code":"KRW-X","timestamp":3}', "orderbook", "KRW-X", "3", 3000),
    ("upbit", '{"ty":null,"type":"orderbook"}', "other", None, None, None),
    ("upbit", '{"ty":"orderbook","tms":null,"timestamp":3}', "orderbook", "unknown", "null", 0),
    ("upbit", '{"ty":"trade","sequential_id":8,"ttms":"4","trade_timestamp":5}', "trade", "unknown", "8", 0),
    ("upbit", '{"ty":"trade","trade_timestamp":5}', "trade", "unknown", "5", 5000),
    ("upbit", '{"status":"UP"}', "other", None, None, None),
    ("Binance", '{"e":"trade","t":1}', "trade", "unknown", "1", 0),
    ("kraken", '{"e":"trade","t":1}', "error", None, None, None),
    (None, "{}", "error", None, None, None),
    *[("bybit", frame, "error", None, None, None) for frame in
      ('{"a":1', '{"a":1} x', "", "  ", '{"a":1}]x[{"b":1}', "1,2", "NaN", "[1,]", "{'a':1}", "1} x", '{"a":01}', None)],
]


@pytest.fixture(scope="module")
def parsed(spark):
    cases = golden() + EDGES
    rows = [(venue, "BTC-USD", "f", i, frame) for i, (venue, frame, *_) in enumerate(cases)]
    frames = spark.createDataFrame(rows, "exchange string, native_symbol string, feed string, timestamp_collector long, frame string")
    return cases, {row.timestamp_collector: row for row in parse_frames(frames.repartition(3)).collect()}, parse_frames(frames)


def test_every_golden_frame_is_there():
    assert len(golden()) == 12


def test_kinds_and_fields(parsed):
    cases, rows, _ = parsed
    for i, (venue, frame, kind, symbol, sequence, time) in enumerate(cases):
        row = rows[i]
        assert (row.kind, row.msg_symbol, row.sequence_id, row.timestamp_exchange_us) == (kind, symbol, sequence, time), (venue, frame)
        assert row.data == (frame if kind in ("orderbook", "trade", "other") else None), (venue, frame)
        assert (row.error is None) == (kind != "error"), (venue, frame)


def test_error_texts_and_notices(spark):
    frames = spark.createDataFrame([
        ("binance", "A", "f", 0, '{"error":{"code":2}}'), ("kraken", "A", "f", 1, "{}"), ("okx", "A", "f", 2, "{"),
        ("okx", "A", "f", 3, '{"event":"notice","code":"64008","msg":"m"}'), ("okx", "A", "f", 4, '{"event":"notice"}'),
    ], "exchange string, native_symbol string, feed string, timestamp_collector long, frame string")
    rows = parse_frames(frames).orderBy("timestamp_collector").collect()
    assert [row.error for row in rows] == ['Binance error: {"code":2}', "unknown exchange: kraken", "invalid JSON", None, None]
    assert [(row.notice_code, row.notice_msg) for row in rows[3:]] == [("64008", "m"), ("unknown", "")]


def test_market_events_use_the_subscribed_symbol(parsed):
    _, _, df = parsed
    events = market_events(df)
    assert events.columns == MARKET_EVENT.names
    assert {row.symbol for row in events.select("symbol").distinct().collect()} == {"btcusd"}
    assert events.count() == data_rows(df).count()
    assert set(PARSED_COLUMNS) <= set(df.columns)
    assert dead_letters(df).where("error IS NULL").count() == 0


def test_a_filter_on_kind_does_not_parse_twice(parsed):
    _, _, df = parsed
    plan = market_events(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
