"""Counts, latency, sequences, silence, sessions, parse errors and rotation groups."""

from pyspark.sql import functions as F

from tickharbor.operators import quality as Q
from tickharbor.operators.parsing import market_events, parse_frames
from tickharbor.operators.rotation import LOOK_ROWS, MAX_FILE_AGE_US, MAX_FILE_BYTES, rotation_files, row_bytes
from tickharbor.plans.catalog import END_US, START_US, add
from tickharbor.plans.frames import DUCK_EXPECTED
from tickharbor.sources.archive import hourly_groups
from tickharbor.sources.config import market_streams
from tickharbor.sources.sample_market import DUCK_MARKET, landed_frames, market_base
from tickharbor.sources.sample_metrics import DUCK_CONFIG, DUCK_UPLOADS, sample_config, upload_log

# Seconds without data after which a market is stale, unless its configuration says otherwise.
TIMEOUT_SECONDS = 180

add("message_counts", lambda spark, d: Q.message_counts(market_base(spark, d)), "AGG-1",
    f"WITH {DUCK_MARKET} SELECT exchange, symbol, data_type, count(*) AS messages FROM priced GROUP BY ALL")

add("last_message_seconds", lambda spark, d: Q.last_message_seconds(market_base(spark, d)), "AGG-2",
    f"WITH {DUCK_MARKET} SELECT exchange, symbol, max(timestamp_collector) // 1000000 AS last_message_s FROM priced GROUP BY ALL")


def duck_histogram(source: str, keys: str, value: str, bounds: list[float]) -> str:
    names = ", ".join(f"('{Q.le_label(b)}', CAST({b} AS DOUBLE))" for b in bounds) + ", ('+Inf', CAST('infinity' AS DOUBLE))"
    return f"""SELECT {keys}, observations, total, le, CAST(sum(CASE WHEN v <= bound THEN n ELSE 0 END) AS BIGINT) AS cumulative
FROM (SELECT {keys}, v, n, CAST(sum(n) OVER (PARTITION BY {keys}) AS BIGINT) AS observations, sum(v * n) OVER (PARTITION BY {keys}) AS total
      FROM (SELECT {keys}, {value} AS v, count(*) AS n FROM {source} WHERE {value} IS NOT NULL GROUP BY ALL))
CROSS JOIN (VALUES {names}) AS bounds(le, bound) GROUP BY ALL"""


LATENCY = "CASE WHEN timestamp_collector > timestamp_exchange THEN (timestamp_collector - timestamp_exchange) // 1000 END"

add("latency_histogram", lambda spark, d: Q.latency_histogram(market_base(spark, d)), "AGG-3, FLT-2, FN-12",
    f"WITH {DUCK_MARKET} " + duck_histogram("priced", "exchange, symbol, data_type", LATENCY, Q.LATENCY_BOUNDS_MS)
    .replace("observations, total, le", "observations, CAST(total AS BIGINT) AS total, le"))


def _upload_histogram(spark, d):
    """The sum of durations as a decimal, which does not depend on the order of the rows."""
    uploads = upload_log(spark, d).withColumn("duration_s", F.col("duration_s").cast("decimal(18,6)"))
    return Q.upload_histogram(uploads).withColumn("total", F.col("total").cast("decimal(28,6)"))


add("upload_duration_histogram", _upload_histogram, "AGG-9",
    f"WITH {DUCK_UPLOADS} SELECT status, observations, CAST(total AS DECIMAL(28,6)) AS total, le, cumulative FROM ("
    + duck_histogram("uploads", "status", "CAST(duration_s AS DECIMAL(18,6))", Q.UPLOAD_BOUNDS_S) + ")")

add("upload_summary", lambda spark, d: Q.upload_summary(upload_log(spark, d)), "AGG-9",
    f"""WITH {DUCK_UPLOADS} SELECT count(*) AS uploads, count(*) FILTER (status <> 'success') AS failures,
  CAST(sum(retries) AS BIGINT) AS retries FROM uploads""")

# --- sequences --------------------------------------------------------------------------------

_KEYS = "exchange, symbol, data_type"
DUCK_CHECKED = f"""
{DUCK_MARKET},
marked AS (SELECT {_KEYS}, timestamp_collector, event_id, seq AS sequence, max(seq) OVER (PARTITION BY {_KEYS}
  ORDER BY timestamp_collector, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest_before FROM priced),
checked AS (SELECT *, CASE WHEN highest_before IS NULL THEN 'first' WHEN sequence = highest_before THEN 'duplicate'
  WHEN sequence < highest_before THEN 'out_of_order' WHEN sequence > highest_before + 1 THEN 'gap' ELSE 'ok' END AS result,
  CASE WHEN sequence > highest_before + 1 THEN sequence - highest_before - 1 ELSE 0 END AS gap_size FROM marked)
""".strip()


def _checked(spark, d):
    return Q.sequence_check(market_base(spark, d), "event_id")


add("sequence_check", _checked, "WIN-1, FN-15", f"WITH {DUCK_CHECKED} SELECT * FROM checked")

add("sequence_summary", lambda spark, d: Q.sequence_summary(_checked(spark, d)), "AGG-10",
    f"""WITH {DUCK_CHECKED} SELECT {_KEYS}, count(*) FILTER (result = 'gap') AS gaps, count(*) FILTER (result = 'out_of_order') AS out_of_order,
  count(*) FILTER (result = 'duplicate') AS duplicates, count(*) FILTER (result = 'ok') AS in_order,
  CAST(sum(gap_size) AS BIGINT) AS missing, max(gap_size) AS largest_gap FROM checked GROUP BY {_KEYS}""")

add("gap_sizes", lambda spark, d: Q.gap_sizes(_checked(spark, d)), "AGG-10",
    f"WITH {DUCK_CHECKED} SELECT gap_size, count(*) AS gaps FROM checked WHERE result = 'gap' GROUP BY gap_size")

_DEDUP = ["event_id", "exchange", "symbol", "data_type", "exchange_sequence_id", "timestamp_collector", "timestamp_exchange"]

add("first_arrivals", lambda spark, d: Q.first_arrivals(market_base(spark, d).select(*_DEDUP), "event_id"), "WIN-2",
    f"""WITH {DUCK_MARKET} SELECT {', '.join(_DEDUP)} FROM priced
QUALIFY row_number() OVER (PARTITION BY {_KEYS}, exchange_sequence_id ORDER BY timestamp_collector, event_id) = 1""")

add("duplicates_dropped", lambda spark, d: Q.duplicates_dropped(market_base(spark, d)), "AGG-10, WIN-2",
    f"""WITH {DUCK_MARKET} SELECT {_KEYS}, CAST(count(*) - count(DISTINCT exchange_sequence_id) AS BIGINT) AS dropped
FROM priced GROUP BY {_KEYS}""")

# --- silence ----------------------------------------------------------------------------------

_STREAM = "exchange, symbol, feed"


def _stale(spark, d):
    streams = market_streams(sample_config(spark, d))
    return Q.stale_periods(Q.with_timeout(market_base(spark, d), streams, TIMEOUT_SECONDS), "event_id")


add("stale_periods", _stale, "WIN-3, SRC-3", f"""WITH {DUCK_MARKET}, {DUCK_CONFIG},
linked AS (SELECT p.exchange, p.symbol, p.feed, event_id, timestamp_collector AS resumed_us, coalesce(data_timeout_secs, {TIMEOUT_SECONDS}) * 1000000 AS lim,
  lag(timestamp_collector) OVER (PARTITION BY p.exchange, p.symbol, p.feed ORDER BY timestamp_collector, event_id) AS previous_us
  FROM priced p LEFT JOIN streams s ON p.exchange = s.exchange AND p.symbol = s.symbol AND p.feed = s.feed)
SELECT {_STREAM}, event_id, previous_us, resumed_us, resumed_us - previous_us AS silence_us,
  CASE WHEN resumed_us - previous_us > 3 * lim THEN 'reconnect' ELSE 'warn' END AS action
FROM linked WHERE resumed_us - previous_us > lim""")

# Every stream subscribes anew at the start of each of these hours.
_SUBSCRIBED = [1_704_067_200_000_000 + day * 86_400_000_000 for day in range(0, 30, 3)]


def _subscriptions(spark, d):
    from pyspark.sql import functions as F

    streams = market_streams(sample_config(spark, d))
    moments = F.explode(F.array(*[F.lit(us).cast("bigint") for us in _SUBSCRIBED]))
    return streams.select(*Q.STREAM_KEY, moments.alias("subscribed_us"),
                          F.coalesce("data_timeout_secs", F.lit(TIMEOUT_SECONDS)).cast("bigint").alias("timeout_s"))


add("silent_subscriptions", lambda spark, d: Q.silent_subscriptions(_subscriptions(spark, d), market_base(spark, d), END_US), "WIN-4",
    f"""WITH {DUCK_MARKET}, {DUCK_CONFIG},
asked AS (SELECT {_STREAM}, subscribed_us, coalesce(data_timeout_secs, {TIMEOUT_SECONDS}) AS timeout_s FROM streams
  CROSS JOIN (SELECT unnest({_SUBSCRIBED}) AS subscribed_us)),
waited AS (SELECT a.exchange, a.symbol, a.feed, subscribed_us, timeout_s, min(timestamp_collector) AS first_us
  FROM asked a LEFT JOIN priced p ON a.exchange = p.exchange AND a.symbol = p.symbol AND a.feed = p.feed AND timestamp_collector >= subscribed_us
  GROUP BY ALL)
SELECT {_STREAM}, subscribed_us, first_us, coalesce(first_us, {END_US}) - subscribed_us AS waited_us,
  CASE WHEN coalesce(first_us, {END_US}) - subscribed_us > timeout_s * 3000000 THEN 'reconnect'
    WHEN coalesce(first_us, {END_US}) - subscribed_us > 30000000 THEN 'warn' ELSE 'ok' END AS action FROM waited""")

DUCK_TIMEOUTS = f"""
marks AS (SELECT {_STREAM}, timestamp_collector AS us, 1 AS rank FROM priced WHERE timestamp_collector >= {START_US} AND timestamp_collector < {END_US}
  UNION ALL SELECT {_STREAM}, {START_US}, 0 FROM streams UNION ALL SELECT {_STREAM}, {END_US}, 2 FROM streams),
silences AS (SELECT {_STREAM}, us, lag(us) OVER w AS since, lag(rank) OVER w AS was FROM marks WINDOW w AS (PARTITION BY {_STREAM} ORDER BY us, rank)),
timeouts AS (SELECT l.exchange, l.symbol, l.feed, CASE WHEN was = 0 THEN 'never_received' ELSE 'stalled' END AS cause, since AS silent_since_us,
  unnest(range(since + coalesce(data_timeout_secs, {TIMEOUT_SECONDS}) * 3000000, us, coalesce(data_timeout_secs, {TIMEOUT_SECONDS}) * 3000000)) AS at_us
  FROM silences l JOIN streams s ON l.exchange = s.exchange AND l.symbol = s.symbol AND l.feed = s.feed WHERE since IS NOT NULL)
""".strip()


def message_timeouts(spark, d):
    streams = market_streams(sample_config(spark, d)).select(
        *Q.STREAM_KEY, F.coalesce("data_timeout_secs", F.lit(TIMEOUT_SECONDS)).cast("bigint").alias("timeout_s"))
    return Q.message_timeouts(market_base(spark, d), streams, START_US, END_US)


add("message_timeouts", lambda spark, d: message_timeouts(spark, d).groupBy(*Q.STREAM_KEY, "cause", "silent_since_us").agg(
    F.count("*").alias("timeouts"), F.max("at_us").alias("last_us")), "WIN-3, WIN-4",
    f"""WITH {DUCK_MARKET}, {DUCK_CONFIG}, {DUCK_TIMEOUTS}
SELECT {_STREAM}, cause, silent_since_us, count(*) AS timeouts, max(at_us) AS last_us FROM timeouts GROUP BY ALL""")

DUCK_SESSIONS = f"""
linked AS (SELECT {_STREAM}, event_id, timestamp_collector,
  lag(timestamp_collector) OVER (PARTITION BY {_STREAM} ORDER BY timestamp_collector, event_id) AS previous_us FROM priced),
numbered AS (SELECT *, CAST(sum(CASE WHEN previous_us IS NULL OR timestamp_collector - previous_us > 90000000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY {_STREAM} ORDER BY timestamp_collector, event_id) AS BIGINT) AS session FROM linked),
sessions AS (SELECT {_STREAM}, session, min(timestamp_collector) AS opened_us, max(timestamp_collector) AS closed_us, count(*) AS frames
  FROM numbered GROUP BY {_STREAM}, session)
""".strip()

add("connection_sessions", lambda spark, d: Q.sessions(market_base(spark, d), "event_id"), "WIN-5",
    f"WITH {DUCK_MARKET}, {DUCK_SESSIONS} SELECT * FROM sessions")

add("disconnect_diagnostics", lambda spark, d: Q.disconnect_diagnostics(parse_frames(landed_frames(spark, d)), "event_id"), "WIN-6",
    f"""WITH {DUCK_EXPECTED},
running AS (SELECT {_STREAM}, timestamp_collector, event_id, lag(timestamp_collector) OVER w AS any_us,
  max(CASE WHEN kind IN ('orderbook', 'trade') THEN timestamp_collector END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS data_us,
  max(CASE WHEN kind = 'pong' THEN timestamp_collector END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pong_us
  FROM expected WINDOW w AS (PARTITION BY {_STREAM} ORDER BY timestamp_collector, event_id))
SELECT {_STREAM}, timestamp_collector, event_id, (timestamp_collector - data_us) // 1000000 AS secs_since_data,
  (timestamp_collector - pong_us) // 1000000 AS secs_since_pong, (timestamp_collector - any_us) // 1000000 AS secs_since_any_frame
FROM running WHERE timestamp_collector - any_us > 90000000""")

# --- parse errors -----------------------------------------------------------------------------


def duck_error_windows(seconds: int, ratio: float, least: int) -> str:
    return f"""SELECT *, errors / samples AS error_ratio, samples >= {least} AND errors / samples >= {ratio} AND errors > 0 AS tripped
FROM (SELECT {_STREAM}, timestamp_collector // {seconds}000000 * {seconds}000000 AS window_us, count(*) FILTER (kind = 'error') AS errors, count(*) AS samples
  FROM expected WHERE kind IN ('orderbook', 'trade', 'error') GROUP BY ALL)"""


add("parse_error_minutes", lambda spark, d: Q.parse_error_windows(parse_frames(landed_frames(spark, d))), "AGG-5",
    f"WITH {DUCK_EXPECTED} {duck_error_windows(60, 0.5, 100)}")

# The test period is too quiet for a minute to reach 100 samples, so this one looks at days.
DAY_BREAKER = {"window_seconds": 86_400, "ratio": 0.1, "min_samples": 5}

add("parse_error_days", lambda spark, d: Q.parse_error_windows(parse_frames(landed_frames(spark, d)), **DAY_BREAKER), "AGG-5",
    f"WITH {DUCK_EXPECTED} {duck_error_windows(86_400, 0.1, 5)}")


def duck_breaker(window_seconds: int = 60, ratio: float = 0.5, min_samples: int = 100) -> str:
    """Windows that open with a row, with every error as a test: relation ``checks``; needs WITH RECURSIVE."""
    return f"""{DUCK_EXPECTED}, counted AS (SELECT {_STREAM}, timestamp_collector, event_id, kind FROM expected WHERE kind IN ('orderbook', 'trade', 'error')),
opened AS (SELECT {_STREAM}, min(timestamp_collector) AS opened_us FROM counted GROUP BY {_STREAM}
  UNION ALL SELECT {_STREAM}, next_us FROM (SELECT o.exchange, o.symbol, o.feed, min(c.timestamp_collector) AS next_us
    FROM opened o JOIN counted c ON o.exchange = c.exchange AND o.symbol = c.symbol AND o.feed = c.feed
    AND c.timestamp_collector > o.opened_us + {window_seconds}000000 GROUP BY ALL)),
placed AS (SELECT c.*, o.opened_us FROM counted c ASOF JOIN opened o ON c.exchange = o.exchange AND c.symbol = o.symbol AND c.feed = o.feed
  AND c.timestamp_collector >= o.opened_us),
summed AS (SELECT *, CAST(sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS errors, count(*) OVER w AS samples FROM placed
  WINDOW w AS (PARTITION BY {_STREAM}, opened_us ORDER BY timestamp_collector, event_id ROWS UNBOUNDED PRECEDING)),
checks AS (SELECT {_STREAM}, event_id, timestamp_collector, opened_us, errors, samples, errors / samples AS error_ratio,
  samples >= {min_samples} AND errors / samples >= {ratio} AS tripped FROM summed WHERE kind = 'error')"""


# The same days from the first row on: windows open with a row, and every error is a test.
add("breaker_checks", lambda spark, d: Q.breaker_checks(parse_frames(landed_frames(spark, d)), "event_id", **DAY_BREAKER), "AGG-5",
    f"WITH RECURSIVE {duck_breaker(**DAY_BREAKER)} SELECT * FROM checks")

# Windows in which the breaker opens its circuit, with the numbers of the days.
add("breaker_trips", lambda spark, d: Q.breaker_trips(Q.breaker_checks(parse_frames(landed_frames(spark, d)), "event_id", **DAY_BREAKER)), "AGG-5",
    f"""WITH RECURSIVE {duck_breaker(**DAY_BREAKER)} SELECT {_STREAM}, opened_us, min(timestamp_collector) AS tripped_us
FROM checks WHERE tripped GROUP BY ALL""")

# --- rotation ---------------------------------------------------------------------------------

# The same rules with numbers that the test tables reach: most files close by size before they are two days old.
SMALL_FILES = {"age_us": 2 * 86_400_000_000, "max_bytes": 1_200, "look_rows": 3}
_TEXTS = ["exchange", "symbol", "exchange_sequence_id", "data"]


def duck_files(age_us: int = MAX_FILE_AGE_US, max_bytes: int = MAX_FILE_BYTES, look_rows: int = LOOK_ROWS) -> str:
    """Openings of files by key, one after another; needs the expected frames and WITH RECURSIVE."""
    return f"""
sized AS MATERIALIZED (SELECT exchange, symbol, kind AS data_type, timestamp_collector, row_number() OVER w AS rn,
  strlen(exchange) + strlen(symbol) + strlen(sequence_id) + strlen(data) + 16 AS size,
  coalesce(sum(strlen(exchange) + strlen(symbol) + strlen(sequence_id) + strlen(data) + 16) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM expected WHERE kind IN ('orderbook', 'trade') WINDOW w AS (PARTITION BY exchange, symbol, kind ORDER BY timestamp_collector, event_id)),
opened AS (SELECT {_KEYS}, rn, timestamp_collector AS opened_us, before FROM sized WHERE rn = 1
  UNION ALL SELECT * FROM (SELECT o.exchange, o.symbol, o.data_type, min(p.rn), arg_min(p.timestamp_collector, p.rn), arg_min(p.before, p.rn)
    FROM opened o JOIN sized p ON o.exchange = p.exchange AND o.symbol = p.symbol AND o.data_type = p.data_type AND p.rn > o.rn
    AND (p.timestamp_collector > o.opened_us + {age_us} OR (p.rn - o.rn) % {look_rows} = 0 AND p.before - o.before > {max_bytes}) GROUP BY ALL))
""".strip()


def duck_rotation(**rules: int) -> str:
    return f"""WITH RECURSIVE {DUCK_EXPECTED}, {duck_files(**rules)},
files AS (SELECT p.exchange, p.symbol, p.data_type, o.rn, o.opened_us, p.timestamp_collector, p.size
  FROM sized p ASOF JOIN opened o ON p.exchange = o.exchange AND p.symbol = o.symbol AND p.data_type = o.data_type AND p.rn >= o.rn)
SELECT {_KEYS}, opened_us, max(timestamp_collector) AS last_us, count(*) AS rows, CAST(sum(size) AS BIGINT) AS bytes
FROM files GROUP BY {_KEYS}, rn, opened_us"""


def rotated(spark, d, **rules):
    events = market_events(parse_frames(landed_frames(spark, d)), "event_id")
    return rotation_files(events, size=row_bytes(_TEXTS), tiebreak="event_id", **rules)


add("rotation_files", rotated, "WIN-7, SNK-2", duck_rotation())

add("rotation_files_by_size", lambda spark, d: rotated(spark, d, **SMALL_FILES), "WIN-7, SNK-2", duck_rotation(**SMALL_FILES))

add("hourly_groups", lambda spark, d: hourly_groups(market_base(spark, d)), "SNK-2",
    f"""WITH {DUCK_MARKET} SELECT {_KEYS}, timestamp_collector // 3600000000 AS hour, min(timestamp_collector) AS first_us,
  max(timestamp_collector) AS last_us, count(*) AS rows FROM priced GROUP BY ALL""")
