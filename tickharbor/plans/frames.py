"""Frame parsing and scalar functions."""

from pyspark.sql import functions as F

from tickharbor.functions import scalars as S
from tickharbor.operators.parsing import dead_letters, market_events, parse_frames, parse_venue
from tickharbor.plans.catalog import add
from tickharbor.sources.frames import sample_frames
from tickharbor.sources.sample_market import DUCK_FRAMES, DUCK_MARKET, landed_frames, market_base
from tickharbor.venues import VENUES
from tickharbor.venues.subscriptions import api_symbol, stream_channel

_COLUMNS = ["event_id", "exchange", "kind", "msg_symbol", "sequence_id", "timestamp_exchange_us",
            "data", "error", "notice_code", "notice_msg"]

# What each frame must parse to, from the columns it was built from and not from its text.
DUCK_EXPECTED = f"""
{DUCK_FRAMES},
kinds AS (SELECT *, CASE event_id % 41 WHEN 7 THEN 'other' WHEN 19 THEN 'error' WHEN 29 THEN
    CASE exchange WHEN 'coinbase' THEN 'other' WHEN 'okx' THEN 'pong' WHEN 'bybit' THEN 'pong' ELSE 'error' END
    ELSE data_type END AS kind FROM landed),
expected AS (SELECT event_id, exchange, native_symbol, symbol, feed, timestamp_collector, frame, kind,
  CASE WHEN kind = data_type THEN CASE WHEN exchange <> 'binance' THEN native_symbol WHEN kind = 'trade' THEN upper(native_symbol) ELSE 'unknown' END END AS msg_symbol,
  CASE WHEN kind = data_type THEN CASE WHEN exchange = 'coinbase' AND kind = 'orderbook' AND event_id % 5 < 2 THEN iso
    WHEN exchange = 'upbit' AND kind = 'orderbook' THEN CAST(ts_ms AS VARCHAR) ELSE exchange_sequence_id END END AS sequence_id,
  CASE WHEN kind = data_type THEN timestamp_exchange END AS timestamp_exchange_us,
  CASE WHEN kind NOT IN ('pong', 'error') THEN frame END AS data,
  CASE WHEN kind = 'error' THEN CASE WHEN event_id % 41 = 29 AND exchange = 'binance' THEN 'Binance error: {{"code":' || event_id || '}}' ELSE 'invalid JSON' END END AS error,
  CASE WHEN exchange = 'okx' AND event_id % 41 = 7 THEN '64008' END AS notice_code,
  CASE WHEN exchange = 'okx' AND event_id % 41 = 7 THEN 'upgrade ' || event_id END AS notice_msg
  FROM kinds)
""".strip()

_COVERS = {"binance": "PRS-B1..B6", "coinbase": "PRS-C1..C7", "okx": "PRS-O1..O5", "bybit": "PRS-Y1..Y4", "upbit": "PRS-U1..U3"}


def _venue_query(name):
    return lambda spark, d: parse_venue(landed_frames(spark, d), name).select(*_COLUMNS)


for _name in VENUES:
    add(f"parse_{_name}", _venue_query(_name), f"{_COVERS[_name]}, PRS-E, FN-6..FN-9, LIM-1",
        f"WITH {DUCK_EXPECTED} SELECT {', '.join(_COLUMNS)} FROM expected WHERE exchange = '{_name}'")

add("parse_all_venues", lambda spark, d: parse_frames(landed_frames(spark, d)).select(*_COLUMNS),
    "SRC-1, PRS-0, PRS-E, SET-1", f"WITH {DUCK_EXPECTED} SELECT {', '.join(_COLUMNS)} FROM expected")

add("market_events", lambda spark, d: market_events(parse_frames(landed_frames(spark, d)), "event_id"),
    "FLT-1, data model", f"""WITH {DUCK_EXPECTED}
SELECT exchange, symbol, kind AS data_type, sequence_id AS exchange_sequence_id, timestamp_collector,
  timestamp_exchange_us AS timestamp_exchange, data, event_id FROM expected WHERE kind IN ('orderbook', 'trade')""")

add("dead_letters", lambda spark, d: dead_letters(parse_frames(landed_frames(spark, d))).select("event_id", "exchange", "frame", "error"),
    "SNK-5", f"WITH {DUCK_EXPECTED} SELECT event_id, exchange, frame, error FROM expected WHERE kind = 'error'")

add("frame_kinds", lambda spark, d: parse_frames(landed_frames(spark, d)).groupBy("exchange", "kind").agg(F.count("*").alias("frames")),
    "PRS-0, AGG-1", f"WITH {DUCK_EXPECTED} SELECT exchange, kind, count(*) AS frames FROM expected GROUP BY ALL")

add("binance_trade_counts", lambda spark, d: market_events(parse_venue(landed_frames(spark, d), "binance")).where("data_type = 'trade'")
    .groupBy("exchange", "symbol", "data_type").agg(F.count("*").alias("messages")),
    "PRS-B4, AGG-1", f"""WITH {DUCK_EXPECTED} SELECT exchange, symbol, kind AS data_type, count(*) AS messages
FROM expected WHERE exchange = 'binance' AND kind = 'trade' GROUP BY ALL""")

add("frame_sample", lambda spark, d: sample_frames(landed_frames(spark, d), 0.01).select("event_id", "frame"), "FLT-8",
    f"WITH {DUCK_FRAMES} SELECT event_id, frame FROM landed WHERE CAST('0x' || substr(md5(frame), 1, 8) AS BIGINT) < {int(0.01 * 2**32)}")


def _scalar_functions(spark, d):
    rows = market_base(spark, d)
    us, ms_text = F.col("timestamp_exchange"), F.col("ts_ms").cast("string")
    return rows.select(
        "event_id",
        S.normalize_symbol("native_symbol").alias("normalized"),
        api_symbol("exchange", "native_symbol").alias("api_symbol"),
        S.ms_to_us(F.when(F.col("event_id") % 5 > 0, F.col("ts_ms"))).alias("from_ms"),
        S.iso8601_to_us(F.when(F.col("event_id") % 3 > 0, F.col("iso")).otherwise(F.substring("iso", 1, 10))).alias("from_iso"),
        S.text_ms_to_us(F.when(F.col("event_id") % 4 > 0, ms_text).otherwise(F.concat(F.lit(" "), ms_text))).alias("from_text"),
        S.latency_ms().alias("latency_ms"),
        S.utc_date(us).alias("utc_date"),
        S.epoch_ms(us).alias("epoch_ms"),
        S.archive_path("exchange", "symbol", "data_type", us).alias("path"),
        S.archive_path("exchange", "symbol", "data_type", us, F.when(F.col("event_id") % 2 == 0, "srv1")).alias("server_path"),
        S.feed_name(F.when(F.col("event_id") % 7 == 0, "Trades").when(F.col("event_id") % 7 == 1, "trade").otherwise(F.col("feed"))).alias("feed_name"),
        stream_channel("exchange", "native_symbol", "feed").alias("channel"),
        S.numeric_sequence(F.when(F.col("event_id") % 6 == 0, F.col("iso")).otherwise(F.col("exchange_sequence_id"))).alias("sequence"),
    )


add("scalar_functions", _scalar_functions, "FN-1..FN-5, FN-10..FN-15", f"""WITH {DUCK_MARKET}
SELECT event_id, symbol AS normalized,
  CASE exchange WHEN 'binance' THEN lower(base) || 'usdt' WHEN 'coinbase' THEN base || '-USD' WHEN 'okx' THEN base || '-USDT'
    WHEN 'bybit' THEN base || 'USDT' ELSE 'KRW-' || base END AS api_symbol,
  CASE WHEN event_id % 5 > 0 THEN ts_ms * 1000 ELSE 0 END AS from_ms,
  CASE WHEN event_id % 3 > 0 THEN ts_ms * 1000 ELSE 0 END AS from_iso,
  CASE WHEN event_id % 4 > 0 THEN ts_ms * 1000 ELSE 0 END AS from_text,
  CASE WHEN timestamp_collector > timestamp_exchange THEN (timestamp_collector - timestamp_exchange) // 1000 END AS latency_ms,
  strftime(make_timestamp(timestamp_exchange), '%Y-%m-%d') AS utc_date, ts_ms AS epoch_ms,
  exchange || '/' || symbol || '/' || data_type || '/' || strftime(make_timestamp(timestamp_exchange), '%Y-%m-%d') || '/' || ts_ms || '.parquet' AS path,
  exchange || '/' || symbol || '/' || data_type || CASE WHEN event_id % 2 = 0 THEN '/srv1/' ELSE '/' END
    || strftime(make_timestamp(timestamp_exchange), '%Y-%m-%d') || '/' || ts_ms || '.parquet' AS server_path,
  CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'trades' ELSE feed END AS feed_name,
  CASE exchange WHEN 'binance' THEN lower(base) || 'usdt' || CASE feed WHEN 'trades' THEN '@trade' ELSE '@depth20@100ms' END
    WHEN 'bybit' THEN CASE feed WHEN 'trades' THEN 'publicTrade.' ELSE 'orderbook.50.' END || base || 'USDT'
    WHEN 'okx' THEN CASE feed WHEN 'trades' THEN 'trades' ELSE 'books' END
    WHEN 'coinbase' THEN CASE feed WHEN 'trades' THEN 'market_trades' ELSE 'level2' END
    ELSE data_type END AS channel,
  CASE WHEN event_id % 6 > 0 THEN seq END AS sequence FROM priced
""")
