"""Configuration, joins with it, health, and file verification."""

from pyspark.sql import functions as F

from tickharbor.operators import joins as J
from tickharbor.plans.catalog import END_US, add

from tickharbor.sources import config as C
from tickharbor.sources.archive import nonempty_files
from tickharbor.sources.sample_market import DUCK_MARKET, market_base
from tickharbor.sources.sample_metrics import DUCK_CONFIG, DUCK_FILES, local_manifest, remote_listing, sample_config

_KEYS = "exchange, symbol, data_type"
_STREAM = "exchange, symbol, feed"
_BASE = f"WITH {DUCK_MARKET}, {DUCK_CONFIG}"


def _streams(spark, d):
    return C.market_streams(sample_config(spark, d))


add("market_streams", lambda spark, d: _streams(spark, d).select("exchange", "native_symbol", "symbol", "feed", "data_timeout_secs"),
    "SRC-3, FN-13", f"{_BASE} SELECT exchange, native_symbol, symbol, feed, CAST(data_timeout_secs AS BIGINT) AS data_timeout_secs FROM streams")

add("subscription_plan", lambda spark, d: C.subscription_plan(_streams(spark, d)).select("exchange", "symbol", "feed", "channel", "instrument"),
    "FN-2, FN-14", f"""{_BASE} SELECT exchange, symbol, feed,
  CASE exchange WHEN 'binance' THEN native_symbol || CASE feed WHEN 'trades' THEN '@trade' ELSE '@depth20@100ms' END
    WHEN 'bybit' THEN CASE feed WHEN 'trades' THEN 'publicTrade.' ELSE 'orderbook.50.' END || native_symbol
    WHEN 'okx' THEN CASE feed WHEN 'trades' THEN 'trades' ELSE 'books' END
    WHEN 'coinbase' THEN CASE feed WHEN 'trades' THEN 'market_trades' ELSE 'level2' END
    ELSE CASE feed WHEN 'trades' THEN 'trade' ELSE 'orderbook' END END AS channel, native_symbol AS instrument FROM streams""")

add("unknown_feeds", lambda spark, d: C.unknown_feeds(sample_config(spark, d)), "FN-13",
    f"{_BASE} SELECT DISTINCT exchange, native_symbol, 'ticker' AS feed_name FROM priced WHERE exchange = 'upbit'")


def _doubled_config(spark, d):
    """The configuration with the markets of one venue a second time in upper case, and an unknown venue."""
    config = sample_config(spark, d)
    again = config.where("exchange = 'binance'").withColumn("exchange", F.lit("Binance")) \
        .withColumn("symbols", F.transform("symbols", F.upper))
    unknown = config.where("exchange = 'okx'").withColumn("exchange", F.lit("kraken"))
    return config.unionByName(again).unionByName(unknown)


add("duplicate_pairs", lambda spark, d: C.duplicate_pairs(_doubled_config(spark, d)), "AGG-7",
    f"{_BASE} SELECT DISTINCT 'binance:' || native_symbol AS pair, CAST(2 AS BIGINT) AS times FROM priced WHERE exchange = 'binance'")

add("distinct_pairs", lambda spark, d: C.distinct_pairs(_doubled_config(spark, d)), "SET-2",
    f"""{_BASE} SELECT DISTINCT exchange || ':' || lower(native_symbol) AS pair FROM streams
UNION SELECT 'kraken:' || lower(native_symbol) FROM streams WHERE exchange = 'okx'""")

add("unsupported_markets", lambda spark, d: C.unsupported_markets(_doubled_config(spark, d)), "FLT-5",
    f"{_BASE} SELECT DISTINCT 'kraken' AS exchange, native_symbol FROM streams WHERE exchange = 'okx'")


def _settings(spark, d):
    """Connection settings per symbol, read off the counts of its messages."""
    counts = market_base(spark, d).groupBy("exchange", "symbol").agg(F.count("*").alias("n"))
    return counts.select(
        "exchange", "symbol", F.when(F.col("n") % 5 > 0, F.col("n") % 7).alias("message_timeout_secs"),
        (F.col("n") % 4).alias("initial_retry_delay_secs"), (F.col("n") % 3).alias("max_retry_delay_secs"))


add("invalid_settings", lambda spark, d: C.invalid_settings(_settings(spark, d)), "FLT-6",
    f"""WITH {DUCK_MARKET}, settings AS (SELECT exchange, symbol, CASE WHEN n % 5 > 0 THEN n % 7 END AS message_timeout_secs,
  n % 4 AS initial_retry_delay_secs, n % 3 AS max_retry_delay_secs FROM (SELECT exchange, symbol, count(*) AS n FROM priced GROUP BY ALL))
SELECT *, 'initial retry delay not below message timeout' AS violation FROM settings WHERE initial_retry_delay_secs >= coalesce(message_timeout_secs, 0)
UNION ALL SELECT *, 'maximum retry delay below initial delay' FROM settings WHERE max_retry_delay_secs < initial_retry_delay_secs""")

add("worker_budget", lambda spark, d: C.worker_budget(sample_config(spark, d)), "AGG-8",
    f"""{_BASE}, pairs AS (SELECT DISTINCT exchange, symbol FROM streams)
SELECT CAST(2 * count(*) AS BIGINT) AS workers, CAST(2000 * count(*) AS BIGINT) AS queue_size FROM pairs""")

# --- joins ------------------------------------------------------------------------------------

def _with_silent_pairs(streams):
    """The configured pairs, and one more per venue that no event has."""
    return streams.select("exchange", "symbol").unionByName(streams.select("exchange", F.lit("silentusdt").alias("symbol")))


add("expected_counts", lambda spark, d: J.expected_counts(_with_silent_pairs(_streams(spark, d)), market_base(spark, d)), "JN-1",
    f"""{_BASE} SELECT e.exchange, e.symbol, e.data_type, count(event_id) AS messages
FROM (SELECT DISTINCT exchange, symbol, t AS data_type FROM (SELECT exchange, symbol FROM streams UNION ALL SELECT exchange, 'silentusdt' FROM streams)
  CROSS JOIN (VALUES ('orderbook'), ('trade')) AS types(t)) e
LEFT JOIN priced p ON e.exchange = p.exchange AND e.symbol = p.symbol AND e.data_type = p.data_type GROUP BY ALL""")

_EVENT = ["event_id", "exchange", "symbol", "data_type", "timestamp_collector"]
_IS_CONFIGURED = "EXISTS (SELECT 1 FROM streams s WHERE s.exchange = p.exchange AND s.symbol = p.symbol AND s.feed = p.feed)"

add("configured_events", lambda spark, d: J.configured_events(market_base(spark, d), _streams(spark, d)).select(*_EVENT), "JN-4, FLT-3",
    f"{_BASE} SELECT {', '.join(_EVENT)} FROM priced p WHERE {_IS_CONFIGURED}")

add("unconfigured_events", lambda spark, d: J.unconfigured_events(market_base(spark, d), _streams(spark, d)).select(*_EVENT), "JN-4",
    f"{_BASE} SELECT {', '.join(_EVENT)} FROM priced p WHERE NOT {_IS_CONFIGURED}")

# A stream counts as connected if it had a frame in the 12 hours before the end of the period.
_UP_US = 12 * 3_600_000_000
DUCK_STATUS = f"""status AS (SELECT s.exchange, s.symbol, s.feed, last_us, coalesce({END_US} - last_us <= {_UP_US}, false) AS up
  FROM (SELECT DISTINCT {_STREAM} FROM streams) s LEFT JOIN (SELECT {_STREAM}, max(timestamp_collector) AS last_us FROM priced
    WHERE timestamp_collector <= {END_US} GROUP BY ALL) l ON s.exchange = l.exchange AND s.symbol = l.symbol AND s.feed = l.feed)"""


def stream_status(spark, d):
    return J.stream_status(_streams(spark, d), market_base(spark, d), END_US, _UP_US)


add("stream_status", stream_status, "JN-3", f"{_BASE}, {DUCK_STATUS} SELECT * FROM status")

add("stream_health", lambda spark, d: J.health(stream_status(spark, d)), "AGG-6, JN-3",
    f"""{_BASE}, {DUCK_STATUS}, n AS (SELECT count(*) FILTER (up) AS up, count(*) AS total FROM status)
SELECT up, total, CAST(0 AS BIGINT) AS messages_dropped,
  CASE WHEN total = 0 THEN 'starting' WHEN up = 0 THEN 'unhealthy' WHEN up < total THEN 'degraded' ELSE 'healthy' END AS status,
  CASE WHEN up > 0 AND up < total THEN 'partial_connections' END AS degraded_reason FROM n""")

# --- files ------------------------------------------------------------------------------------

add("verify_uploads", lambda spark, d: J.verify_copies(local_manifest(spark, d), remote_listing(spark, d)), "JN-2",
    f"""WITH {DUCK_FILES} SELECT coalesce(m.relative_path, l.relative_path) AS relative_path, m.size AS local_size, l.size AS remote_size,
  CASE WHEN l.size IS NULL THEN 'missing' WHEN m.size IS NULL THEN 'unexpected' WHEN m.size <> l.size THEN 'size_mismatch' ELSE 'ok' END AS status
FROM manifest m FULL JOIN listing l ON m.relative_path = l.relative_path""")


def _deletable(spark, d):
    files = local_manifest(spark, d)
    mode = F.element_at(F.array(F.lit("s3"), F.lit("local"), F.lit("both")), (F.col("file_id") % 3 + 1).cast("int"))
    judged = files.select("relative_path", mode.alias("mode"), (F.col("size") % 5 > 0).alias("upload_ok"), (F.col("rows") > 1).alias("copy_ok"))
    return J.deletion_eligibility(judged)


add("deletion_eligibility", _deletable, "FLT-7", f"""WITH {DUCK_FILES}, judged AS (SELECT relative_path,
  CASE file_id % 3 WHEN 0 THEN 's3' WHEN 1 THEN 'local' ELSE 'both' END AS mode, size % 5 > 0 AS upload_ok, rows > 1 AS copy_ok FROM manifest)
SELECT *, CASE mode WHEN 's3' THEN upload_ok WHEN 'local' THEN false ELSE upload_ok AND copy_ok END AS deletable FROM judged""")


def _nonempty(spark, d):
    return nonempty_files(local_manifest(spark, d).withColumn("rows", F.col("rows") - 1)).select("relative_path", "rows", "size")


add("nonempty_files", _nonempty, "FLT-4",
    f"WITH {DUCK_FILES} SELECT relative_path, rows - 1 AS rows, size FROM manifest WHERE rows > 1")

