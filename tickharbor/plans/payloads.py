"""Opened payloads: levels, fills, totals and the current book."""

from pyspark.sql import functions as F

from tickharbor.operators.parsing import market_events, parse_frames
from tickharbor.operators.payload import book_totals, current_book, explode_levels, explode_trades
from tickharbor.plans.catalog import add
from tickharbor.plans.frames import DUCK_EXPECTED
from tickharbor.sources.sample_market import landed_frames
from tickharbor.venues import VENUES


def _events(spark, d):
    return market_events(parse_frames(landed_frames(spark, d)), "event_id")



def _amount(text: str) -> str:
    return f"CAST({text} AS DECIMAL(38,18))"


# The parts of every book message: events, elements of data, or the whole message.
_PARTS = """books AS MATERIALIZED (SELECT event_id, exchange, symbol, timestamp_collector, timestamp_exchange_us AS timestamp_exchange, CAST(data AS JSON) AS j
  FROM expected WHERE kind = 'orderbook'),
parts AS MATERIALIZED (
  SELECT event_id, exchange, 0 AS part, coalesce(exchange IN ('binance', 'upbit') OR j ->> '$.type' = 'snapshot', false) AS snapshot, j AS e
  FROM books WHERE exchange <> 'okx' AND (exchange <> 'coinbase' OR (j -> '$.events') IS NULL)
  UNION ALL SELECT event_id, exchange, i - 1, coalesce(e ->> '$.type' = 'snapshot', false), e FROM (
    SELECT event_id, exchange, unnest(CAST(j -> '$.events' AS JSON[])) AS e, generate_subscripts(CAST(j -> '$.events' AS JSON[]), 1) AS i
    FROM books WHERE exchange = 'coinbase' AND (j -> '$.events') IS NOT NULL)
  UNION ALL SELECT event_id, exchange, i - 1, coalesce(action = 'snapshot', false), e FROM (
    SELECT event_id, exchange, j ->> '$.action' AS action, unnest(CAST(j -> '$.data' AS JSON[])) AS e, generate_subscripts(CAST(j -> '$.data' AS JSON[]), 1) AS i
    FROM books WHERE exchange = 'okx'))"""


def _list_levels(venue: str, path: str, side: str, price: str = "$[0]", size: str = "$[1]", orders: str = "NULL") -> str:
    return f"""SELECT event_id, part, snapshot, {side} AS side, i - 1 AS position, lv ->> '{price}' AS price, lv ->> '{size}' AS size, {orders} AS orders
FROM (SELECT event_id, part, snapshot, unnest(CAST(e -> '{path}' AS JSON[])) AS lv, generate_subscripts(CAST(e -> '{path}' AS JSON[]), 1) AS i
  FROM parts WHERE exchange = '{venue}')"""


def _levels(venue: str) -> str:
    """Levels of one venue's books by the JSON functions of the comparison engine."""
    ladders = {"binance": ("$.bids", "$.asks"), "coinbase": ("$.bids", "$.asks"), "okx": ("$.bids", "$.asks"), "bybit": ("$.data.b", "$.data.a")}
    if venue == "upbit":
        lists = [_list_levels(venue, "$.obu", f"'{side}'", p, q) for side, p, q in (("bid", "$.bp", "$.bs"), ("ask", "$.ap", "$.as"))]
    else:
        orders = "lv ->> '$[3]'" if venue == "okx" else "NULL"
        lists = [_list_levels(venue, path, f"'{side}'", orders=orders) for path, side in zip(ladders[venue], ("bid", "ask"))]
    if venue == "coinbase":
        lists += [_list_levels(venue, "$.changes", "CASE lv ->> '$[0]' WHEN 'buy' THEN 'bid' ELSE 'ask' END", "$[1]", "$[2]"),
                  _list_levels(venue, "$.updates", "CASE lv ->> '$.side' WHEN 'bid' THEN 'bid' ELSE 'ask' END", "$.price_level", "$.new_quantity")]
    return " UNION ALL ".join(lists)


def _duck_books(venues) -> str:
    return f"""{DUCK_EXPECTED},
{_PARTS},
levels AS (SELECT b.event_id, exchange, symbol, timestamp_collector, timestamp_exchange, CAST(part AS INTEGER) AS part, snapshot, side,
  CAST(position AS INTEGER) AS position, {_amount('price')} AS price, {_amount('size')} AS size, CAST(orders AS BIGINT) AS orders
  FROM books b JOIN ({' UNION ALL '.join(_levels(v) for v in venues)}) l ON b.event_id = l.event_id)"""


_COVERS = {"binance": "PAY-1", "coinbase": "PAY-2", "okx": "PAY-3", "bybit": "PAY-4", "upbit": "PAY-5"}


def _levels_query(name):
    return lambda spark, d: explode_levels(_events(spark, d).where(F.col("exchange") == name), "event_id")


for _name in VENUES:
    add(f"levels_{_name}", _levels_query(_name), _COVERS[_name], f"WITH {_duck_books([_name])} SELECT * FROM levels")

add("book_totals", lambda spark, d: book_totals(_events(spark, d), "event_id"), "PAY-5",
    f"""WITH {DUCK_EXPECTED} SELECT event_id, exchange, symbol, timestamp_collector, {_amount("CAST(data AS JSON) ->> '$.tas'")} AS total_ask_size,
  {_amount("CAST(data AS JSON) ->> '$.tbs'")} AS total_bid_size FROM expected WHERE kind = 'orderbook' AND exchange = 'upbit'""")

add("trade_fills", lambda spark, d: explode_trades(_events(spark, d), "event_id"), "PAY-6", f"""WITH {DUCK_EXPECTED},
t AS MATERIALIZED (SELECT event_id, exchange, symbol, timestamp_collector, ts_ms_us, CAST(data AS JSON) AS j FROM (SELECT *, timestamp_exchange_us AS ts_ms_us FROM expected WHERE kind = 'trade')),
f AS (
  SELECT *, coalesce(j ->> '$.t', j ->> '$.a') AS trade_id, j ->> '$.p' AS price, j ->> '$.q' AS size, CASE j ->> '$.m' WHEN 'true' THEN 'sell' ELSE 'buy' END AS side FROM t WHERE exchange = 'binance'
  UNION ALL SELECT *, j ->> '$.trade_id', j ->> '$.price', j ->> '$.size', lower(j ->> '$.side') FROM t WHERE exchange = 'coinbase' AND (j -> '$.events') IS NULL
  UNION ALL SELECT event_id, exchange, symbol, timestamp_collector, ts_ms_us, j, x ->> '$.trade_id', x ->> '$.price', x ->> '$.size', lower(x ->> '$.side')
    FROM (SELECT *, unnest(CAST(j -> '$.events[0].trades' AS JSON[])) AS x FROM t WHERE exchange = 'coinbase' AND (j -> '$.events') IS NOT NULL)
  UNION ALL SELECT event_id, exchange, symbol, timestamp_collector, ts_ms_us, j, x ->> '$.tradeId', x ->> '$.px', x ->> '$.sz', x ->> '$.side'
    FROM (SELECT *, unnest(CAST(j -> '$.data' AS JSON[])) AS x FROM t WHERE exchange = 'okx')
  UNION ALL SELECT event_id, exchange, symbol, timestamp_collector, ts_ms_us, j, x ->> '$.i', x ->> '$.p', x ->> '$.v', lower(x ->> '$.S')
    FROM (SELECT *, unnest(CAST(j -> '$.data' AS JSON[])) AS x FROM t WHERE exchange = 'bybit')
  UNION ALL SELECT *, j ->> '$.sid', j ->> '$.tp', j ->> '$.tv', CASE j ->> '$.ab' WHEN 'ASK' THEN 'sell' ELSE 'buy' END FROM t WHERE exchange = 'upbit')
SELECT event_id, exchange, symbol, timestamp_collector, trade_id, {_amount('price')} AS price, {_amount('size')} AS size, side, ts_ms_us AS trade_time_us FROM f""")

add("current_book", lambda spark, d: current_book(_events(spark, d), "event_id"), "PAY-7",
    f"""WITH {_duck_books(VENUES)},
starts AS (SELECT b.exchange, symbol, max(ROW(timestamp_collector, b.event_id, CAST(part AS INTEGER))) AS start
  FROM books b JOIN parts p ON b.event_id = p.event_id WHERE snapshot GROUP BY ALL),
since AS (SELECT l.* FROM levels l LEFT JOIN starts s ON l.exchange = s.exchange AND l.symbol = s.symbol
  WHERE start IS NULL OR ROW(timestamp_collector, event_id, part) >= start),
latest AS (SELECT exchange, symbol, side, price, size, max(timestamp_collector) OVER (PARTITION BY exchange, symbol, side, price) AS updated_us FROM since
  QUALIFY row_number() OVER (PARTITION BY exchange, symbol, side, price ORDER BY timestamp_collector DESC, event_id DESC, part DESC, position DESC) = 1)
SELECT * FROM latest WHERE size > 0""")
