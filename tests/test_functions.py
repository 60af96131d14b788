from pyspark.sql import functions as F

from tickharbor.functions import scalars as S
from tickharbor.venues.subscriptions import api_symbol


def values(spark, column, rows):
    df = spark.createDataFrame([(row,) for row in rows], "x string")
    return [row[0] for row in df.select(column(F.col("x"))).collect()]


def test_symbols(spark):
    assert values(spark, S.normalize_symbol, ["BTC-USDT", "ETH/USD", "eth_eur", "KRW-BTC"]) == ["btcusdt", "ethusd", "etheur", "krwbtc"]
    assert values(spark, lambda c: api_symbol(c, F.lit("btc-Usd")), ["binance", "bybit", "okx", "kraken"]) == [
        "btc-usd", "BTCUSD", "BTC-USD", None]


def test_times(spark):
    assert values(spark, S.iso8601_to_us, [
        "2023-01-01T00:03:02.136000Z", "2023-01-01", "2023-01-01T00:00:00", "2023-01-01T01:00:00+01:00", "2023-13-01T00:00:00Z",
        "2023-01-01T00:00:00.123456789Z", None,
    ]) == [1672531382136000, 0, 0, 1672531200000000, 0, 1672531200123456, 0]
    assert values(spark, S.text_ms_to_us, ["12", " 12", "+3", "1.5", "", "9223372036854775807", None]) == [12000, 0, 3000, 0, 0, 0, 0]


def test_latency_cuts_towards_zero_and_skips_skew(spark):
    df = spark.createDataFrame([(1999, 1), (5, 9), (1_000_000, 0), (2001, 1)], "c long, e long")
    assert [row[0] for row in df.select(S.latency_ms("c", "e")).collect()] == [1, None, None, 2]


def test_paths(spark):
    df = spark.createDataFrame([("b", "s", "trade", 1672531382136000, None), ("b", "s", "trade", 1672531382136000, "srv")],
                               "e string, s string, t string, us long, server string")
    assert [row[0] for row in df.select(S.archive_path("e", "s", "t", "us", "server")).collect()] == [
        "b/s/trade/2023-01-01/1672531382136.parquet", "b/s/trade/srv/2023-01-01/1672531382136.parquet"]


def test_feeds_and_sequences(spark):
    assert values(spark, S.feed_name, ["orderbook", "trade", "trades", "Trades", "x"]) == ["orderbook", "trades", "trades", None, None]
    assert values(spark, S.numeric_sequence, ["9", "10", '"9"', "2023-01-01T00:00:00Z", "99999999999999999999"]) == [9, 10, None, None, None]
