"""Market data derived from the generic ``events`` table.

The test tables hold no venue frames, so each event is turned into the frame a
venue would have sent for it. The derivation is a projection of SQL expressions
that Spark and the comparison engine both understand; only a few functions have
different names, and those are filled in per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.session import configure, spread

# Names that differ between the two SQL dialects.
SPARK_SQL = {
    "MS": "unix_micros(CAST(ts AS TIMESTAMP)) div 1000",
    "US": "unix_micros(CAST(ts AS TIMESTAMP))",
    "TEXT": "STRING",
    "DIV": "div",
    "ISO": "date_format(timestamp_millis(ts_ms), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
}
DUCK_SQL = {
    "MS": "epoch_us(ts) // 1000",
    "US": "epoch_us(ts)",
    "TEXT": "VARCHAR",
    "DIV": "//",
    "ISO": "strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')",
}

# Projection 1: venue, asset, feed and times of an event.
_EVENT = """
event_id, user_id, value,
CASE event_type WHEN 'click' THEN 'binance' WHEN 'view' THEN 'coinbase' WHEN 'purchase' THEN 'okx'
  WHEN 'signup' THEN 'bybit' ELSE 'upbit' END AS exchange,
CASE user_id % 4 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' WHEN 2 THEN 'SOL' ELSE 'XRP' END AS base,
CASE WHEN event_id % 3 = 0 THEN 'trade' ELSE 'orderbook' END AS data_type,
CASE WHEN event_id % 3 = 0 THEN 'trades' ELSE 'orderbook' END AS feed,
CASE WHEN event_id % 50 = 0 THEN event_id - 25 ELSE event_id END AS seq,
<MS> AS ts_ms, CAST(round(value * 100) AS BIGINT) AS cents
"""

# Projection 2: symbol, receipt time and price texts.
_PRICED = """
*, CASE exchange WHEN 'binance' THEN lower(base) || 'usdt' WHEN 'coinbase' THEN base || '-USD'
  WHEN 'okx' THEN base || '-USDT' WHEN 'bybit' THEN base || 'USDT' ELSE 'KRW-' || base END AS native_symbol,
lower(CASE exchange WHEN 'coinbase' THEN base || 'USD' WHEN 'upbit' THEN 'KRW' || base ELSE base || 'USDT' END) AS symbol,
CAST(seq AS <TEXT>) AS exchange_sequence_id,
ts_ms * 1000 AS timestamp_exchange,
ts_ms * 1000 + cents * 100 - 1000 * (event_id % 7) AS timestamp_collector,
<ISO> AS iso,
CAST(cents <DIV> 100 AS <TEXT>) || '.' || lpad(CAST(cents % 100 AS <TEXT>), 2, '0') AS px,
CAST((cents + 1) <DIV> 100 AS <TEXT>) || '.' || lpad(CAST((cents + 1) % 100 AS <TEXT>), 2, '0') AS px_up
"""

# Projection 3: the frame as the venue would have sent it, before any damage.
_FRAME = """
*, CASE exchange || ' ' || data_type
WHEN 'binance trade' THEN CASE WHEN event_id % 2 = 0
  THEN '{"e":"trade","E":' || ts_ms || ',"s":"' || upper(native_symbol) || '","t":' || seq || ',"p":"' || px || '","q":"1.25","T":' || ts_ms || ',"m":true}'
  ELSE '{"e":"aggTrade","E":' || ts_ms || ',"s":"' || upper(native_symbol) || '","a":' || seq || ',"p":"' || px || '","q":"2","T":' || ts_ms || ',"m":false}' END
WHEN 'binance orderbook' THEN
  '{"lastUpdateId":' || seq || ',"E":' || ts_ms || ',"bids":[["' || px || '","1.5"]],"asks":[["' || px_up || '","2"],["' || px_up || '0","0.5"]]}'
WHEN 'coinbase trade' THEN CASE WHEN event_id % 2 = 0
  THEN '{"channel":"market_trades","timestamp":"' || iso || '","sequence_num":' || event_id || ',"events":[{"type":"update","trades":[{"trade_id":"' || seq || '","product_id":"' || native_symbol || '","price":"' || px || '","size":"0.5","side":"BUY","time":"' || iso || '"}'
    || CASE WHEN event_id % 4 = 0 THEN ',{"trade_id":"' || event_id || 'b","product_id":"' || native_symbol || '","price":"' || px_up || '","size":"0.25","side":"SELL","time":"' || iso || '"}' ELSE '' END || ']}]}'
  ELSE '{"type":"match","trade_id":' || event_id || ',"sequence":' || seq || ',"product_id":"' || native_symbol || '","time":"' || iso || '","size":"5.2","price":"' || px || '","side":"sell"}' END
WHEN 'coinbase orderbook' THEN CASE event_id % 5
  WHEN 0 THEN '{"type":"l2update","product_id":"' || native_symbol || '","time":"' || iso || '","changes":[["buy","' || px || '","1.5"],["sell","' || px_up || '","0"]]}'
  WHEN 1 THEN '{"type":"snapshot","product_id":"' || native_symbol || '","time":"' || iso || '","bids":[["' || px || '","3"]],"asks":[["' || px_up || '","4"]]}'
  ELSE '{"channel":"l2_data","timestamp":"' || iso || '","sequence_num":' || seq || ',"events":[{"type":"' || CASE WHEN event_id % 10 = 2 THEN 'snapshot' ELSE 'update' END || '","product_id":"' || native_symbol || '","updates":[{"side":"bid","price_level":"' || px || '","new_quantity":"1"},{"side":"offer","price_level":"' || px_up || '","new_quantity":"' || CASE WHEN event_id % 3 = 1 THEN '0' ELSE '2' END || '"}]}'
    || CASE WHEN event_id % 6 = 4 THEN ',{"type":"update","product_id":"' || native_symbol || '","updates":[{"side":"bid","price_level":"' || px || '","new_quantity":"7"}]}'
       WHEN event_id % 6 = 5 THEN ',{"type":"snapshot","product_id":"' || native_symbol || '","updates":[]}' ELSE '' END || ']}' END
WHEN 'okx trade' THEN
  '{"arg":{"channel":"trades","instId":"' || native_symbol || '"},"data":[{"instId":"' || native_symbol || '","tradeId":"' || seq || '","px":"' || px || '","sz":"0.12","side":"buy","ts":"' || ts_ms || '"}'
    || CASE WHEN event_id % 4 = 0 THEN ',{"instId":"' || native_symbol || '","tradeId":"' || event_id || '5","px":"' || px_up || '","sz":"0.3","side":"sell","ts":"' || ts_ms || '"}' ELSE '' END || ']}'
WHEN 'okx orderbook' THEN
  '{"arg":{"channel":"books","instId":"' || native_symbol || '"},"action":"' || CASE WHEN event_id % 10 = 1 THEN 'snapshot' ELSE 'update' END || '","data":[{"asks":[["' || px_up || '","' || CASE WHEN event_id % 4 = 1 THEN '0' ELSE '3' END || '","0","1"]],"bids":[["' || px || '","2","0","2"]],"ts":"' || ts_ms || '","seqId":' || seq || '}'
    || CASE WHEN event_id % 6 = 1 THEN ',{"asks":[],"bids":[["' || px || '","6","0","3"]],"ts":"' || ts_ms || '","seqId":' || (seq + 1) || '}' ELSE '' END || ']}'
WHEN 'bybit trade' THEN
  '{"topic":"publicTrade.' || native_symbol || '","type":"snapshot","ts":' || ts_ms || ',"data":[{"i":"' || seq || '","T":' || ts_ms || ',"p":"' || px || '","v":"0.001","S":"' || CASE WHEN event_id % 2 = 0 THEN 'Buy' ELSE 'Sell' END || '","s":"' || native_symbol || '","BT":false}]}'
WHEN 'bybit orderbook' THEN
  '{"topic":"orderbook.50.' || native_symbol || '","type":"' || CASE WHEN event_id % 10 = 2 THEN 'snapshot' ELSE 'delta' END || '","ts":' || ts_ms || ',"data":{"s":"' || native_symbol || '","b":[["' || px || '","0.3"]],"a":[["' || px_up || '","' || CASE WHEN event_id % 4 = 2 THEN '0' ELSE '0.6' END || '"]],"u":' || seq || ',"seq":' || event_id || '}}'
WHEN 'upbit trade' THEN
  '{"ty":"trade","cd":"' || native_symbol || '","tp":' || cents || ',"tv":0.001,"ab":"' || CASE WHEN event_id % 2 = 0 THEN 'BID' ELSE 'ASK' END || '","ttms":' || ts_ms || ',"sid":' || seq || '}'
ELSE CASE WHEN event_id % 7 = 0
  THEN '{"type":"orderbook","code":"' || native_symbol || '","timestamp":' || ts_ms || ',"obu":[{"ap":' || (cents + 1) || ',"as":0.1,"bp":' || cents || ',"bs":0.2}]}'
  ELSE '{"ty":"orderbook","cd":"' || native_symbol || '","tms":' || ts_ms || ',"tas":0.4,"tbs":0.6,"obu":[{"ap":' || (cents + 1) || ',"as":0.1,"bp":' || cents || ',"bs":0.2},{"ap":' || (cents + 2) || ',"as":0.3,"bp":' || cents || '.5,"bs":0.4}]}' END
END AS whole_frame
"""

# Projection 4: what was landed. One frame in 41 is a reply, one is cut short, one is control traffic.
_LANDED = """
*, CASE event_id % 41
WHEN 7 THEN CASE exchange WHEN 'binance' THEN '{"result":null,"id":' || event_id || '}' WHEN 'coinbase' THEN '{"channel":"subscriptions","events":[]}'
  WHEN 'okx' THEN '{"event":"notice","code":"64008","msg":"upgrade ' || event_id || '"}' WHEN 'bybit' THEN '{"success":true,"ret_msg":"pong","op":"ping"}' ELSE '{"status":"UP"}' END
WHEN 19 THEN substr(whole_frame, 1, length(whole_frame) - 1)
WHEN 29 THEN CASE exchange WHEN 'binance' THEN '{"error":{"code":' || event_id || '}}' WHEN 'coinbase' THEN '{"type":"error","message":"slow"}'
  WHEN 'okx' THEN 'pong' WHEN 'bybit' THEN '{"op":"pong"}' ELSE whole_frame || ' x' END
ELSE whole_frame END AS frame
"""


def _fill(text: str, dialect: dict[str, str]) -> str:
    for name, value in dialect.items():
        text = text.replace(f"<{name}>", value)
    return text.strip()


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(configure(spark).read.parquet(f"{sf_dir}/events.parquet"))


def _project(df: DataFrame, projection: str) -> DataFrame:
    filled = _fill(projection, SPARK_SQL).replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT {filled} FROM {{rows}}", rows=df)


def market_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with venue, symbol, feed, sequence and times, without frames."""
    return _project(_project(events_table(spark, sf_dir), _EVENT), _PRICED)


def landed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_frames`` as landed, with the event id to compare by. One frame in 13 spells its venue with a capital."""
    landed = _project(_project(market_base(spark, sf_dir), _FRAME), _LANDED)
    spelled = F.when(F.col("event_id") % 13 == 0, F.initcap("exchange")).otherwise(F.col("exchange"))
    return landed.select("event_id", spelled.alias("exchange"), "native_symbol", "feed", "timestamp_collector", "frame")


# The same derivations as common table expressions for the comparison engine.
DUCK_MARKET = f"""
priced AS (SELECT {_fill(_PRICED, DUCK_SQL)} FROM (SELECT {_fill(_EVENT, DUCK_SQL)} FROM events))
""".strip()
DUCK_FRAMES = f"""
{DUCK_MARKET},
landed AS (SELECT {_fill(_LANDED, DUCK_SQL)} FROM (SELECT {_fill(_FRAME, DUCK_SQL)} FROM priced))
""".strip()
