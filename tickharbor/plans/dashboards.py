"""The dashboard queries, in the order of the survey: q01 to q25 about the collector, q26 to q48 about its hosts.

Panels that can be counted from the events themselves are; the others read metric samples.
"""

import math

from pyspark.sql import functions as F

from tickharbor.operators import quality as Q
from tickharbor.operators import timeseries as T
from tickharbor.operators.parsing import parse_frames
from tickharbor.plans.catalog import END_US, START_US, add
from tickharbor.plans.config import _BASE as CONFIG_BASE
from tickharbor.plans.config import DUCK_STATUS, stream_status
from tickharbor.plans.frames import DUCK_EXPECTED
from tickharbor.plans.quality import (
    DUCK_SESSIONS, DUCK_TIMEOUTS, LATENCY, duck_breaker, duck_files, duck_histogram, message_timeouts,
    rotated)
from tickharbor.session import work_folder
from tickharbor.sources.config import market_streams
from tickharbor.sources.metrics import (
    instant_of, last_message_samples, message_samples, read_samples, write_samples)
from tickharbor.sources.sample_market import DUCK_MARKET, landed_frames, market_base
from tickharbor.sources.sample_metrics import (
    DUCK_CONFIG, DUCK_UPLOADS, duck_node, duck_process, duck_scrapes, duck_stream, node_samples, process_samples,
    sample_config, series_of, stream_samples, upload_log)

MARKET = f"WITH {DUCK_MARKET}"
MINUTE, FIVE_MINUTES, HOUR = 60, 300, 3600
# Steps at which panels over these ranges are evaluated: ranges overlap.
STEP = {MINUTE: 30, FIVE_MINUTES: 120, HOUR: 1800}
SPAN = (START_US, END_US)


def rounded(df):
    """Sums of fractions depend on the order of addition; six digits do not."""
    return df.withColumn("value", F.round("value", 6))


# --- SQL for the comparison -------------------------------------------------------------------

def listed(labels):
    return "".join(f"{label}, " for label in labels)


def duck_instant(source, labels, where="true"):
    return f"(SELECT {listed(labels)}arg_max(value, ts_us) AS value FROM {source} WHERE ts_us <= {END_US} AND {where} GROUP BY ALL)"


def duck_pairs(source, labels, window, step, where="true"):
    w, s = window * 1_000_000, step * 1_000_000
    over = f"({'PARTITION BY ' + ', '.join(labels) if labels else ''} ORDER BY ts_us)"
    return f"""(SELECT * FROM (SELECT {listed(labels)}ts_us, pt, CASE WHEN value < pv THEN value ELSE value - pv END AS change,
    (ts_us + {s - 1}) // {s} * {s} + k * {s} AS t_us
  FROM (SELECT *, lag(value) OVER {over} AS pv, lag(ts_us) OVER {over} AS pt FROM {source} WHERE {where})
  CROSS JOIN (SELECT unnest(range(0, {-(-window // step)})) AS k) WHERE pt IS NOT NULL)
  WHERE t_us < ts_us + {w} AND pt > t_us - {w})"""


def duck_increase(source, labels, window, step, by):
    return f"(SELECT {listed(by)}t_us, sum(change) AS value FROM {duck_pairs(source, labels, window, step)} GROUP BY ALL)"


def duck_irate(source, labels, window, step, where="true"):
    return f"""(SELECT {listed(labels)}t_us, arg_max(change / ((ts_us - pt) / 1000000), ts_us) AS value
  FROM {duck_pairs(source, labels, window, step, where)} GROUP BY ALL)"""


def duck_quantile(source, by, q):
    """Quantile of (by, le, cumulative) rows."""
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""(SELECT {listed(by)}CASE WHEN isinf(le) THEN prev_le ELSE prev_le + (le - prev_le) * ((rank - prev_n) / (n - prev_n)) END AS value
  FROM (SELECT {listed(by)}le, n, coalesce(lag(le) OVER o, 0.0) AS prev_le, coalesce(lag(n) OVER o, 0.0) AS prev_n,
      {q} * max(n) OVER ({part}) AS rank, max(n) OVER ({part}) AS total
    FROM (SELECT {listed(by)}CASE le WHEN '+Inf' THEN CAST('infinity' AS DOUBLE) ELSE CAST(le AS DOUBLE) END AS le, CAST(sum(cumulative) AS DOUBLE) AS n
      FROM {source} GROUP BY ALL) WINDOW o AS ({part} ORDER BY le))
  WHERE total > 0 AND n >= rank QUALIFY row_number() OVER ({part} ORDER BY le) = 1)"""


# --- collector --------------------------------------------------------------------------------

add("q01_connected", lambda spark, d: stream_status(spark, d).select("exchange", "symbol", "feed", F.col("up").cast("double").alias("value")),
    "Q01, TS-1", f"{CONFIG_BASE}, {DUCK_STATUS} SELECT exchange, symbol, feed, CASE WHEN up THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM status")


def _since_last_message(spark, d):
    keys = ["exchange", "symbol"]
    vec = T.vector(last_message_samples(market_base(spark, d)), "collector_last_message_timestamp_seconds", keys)
    return T.age(T.instant(vec, keys, END_US), END_US)


add("q02_time_since_last_message", _since_last_message, "Q02, TS-10, AGG-2, SRC-4",
    f"{MARKET} SELECT exchange, symbol, CAST({END_US // 1_000_000} - max(timestamp_collector) // 1000000 AS DOUBLE) AS value FROM priced GROUP BY ALL")


def _reconnects(spark, d):
    return Q.sessions(market_base(spark, d), "event_id").where("session > 1")


def duck_steps(window):
    """Evaluation times of the test period."""
    step = STEP[window] * 1_000_000
    return f"(SELECT unnest(range({-(-START_US // step) * step}, {END_US + 1}, {step})) AS t_us)"


def duck_counts(source, ts, by, window, where="true", series=None, per_second=False):
    """Rows in (t - w, t] at each step, 0 where a series has none, by a range join."""
    share = f" / {window}" if per_second else ""
    keys = " AND ".join(["c.t_us = g.t_us", *[f"c.{label} = g.{label}" for label in by]])
    labels = f"(SELECT DISTINCT {', '.join(by)} FROM {series or source} WHERE {where})" if by else "(SELECT 1)"
    return f"""SELECT {''.join(f'g.{label}, ' for label in by)}g.t_us, coalesce(n, 0){share} AS value
FROM (SELECT * FROM {labels} CROSS JOIN {duck_steps(window)}) g
LEFT JOIN (SELECT {listed(by)}t_us, count(*) AS n FROM {source} JOIN {duck_steps(window)} ON {ts} > t_us - {window}000000 AND {ts} <= t_us
  WHERE {where} GROUP BY ALL) c ON {keys}"""


add("q03_reconnects_5m", lambda spark, d: T.event_count(_reconnects(spark, d), ["exchange", "symbol"], FIVE_MINUTES, STEP[FIVE_MINUTES], SPAN,
    "opened_us", market_base(spark, d)), "Q03, TS-3, TS-13, WIN-5",
    f"{MARKET}, {DUCK_SESSIONS}, reconnects AS (SELECT * FROM sessions WHERE session > 1) "
    + duck_counts("reconnects", "opened_us", ["exchange", "symbol"], FIVE_MINUTES, series="priced"))

add("q04_reconnects_total", lambda spark, d: _reconnects(spark, d).agg(F.count("*").alias("value")), "Q04, TS-6",
    f"{MARKET}, {DUCK_SESSIONS} SELECT count(*) AS value FROM sessions WHERE session > 1")


def _stream_rate(metric):
    def run(spark, d):
        keys = ["exchange", "symbol"]
        return T.rate(T.vector(stream_samples(spark, d, metric), metric, keys), keys, MINUTE, MINUTE, by=["exchange"])
    return run


for _number, _name in (("05", "pings_sent"), ("06", "pongs_received")):
    _metric = f"collector_websocket_{_name}_total"
    add(f"q{_number}_{_name}_rate", _stream_rate(_metric), f"Q{_number}, TS-4, TS-6",
        f"{MARKET} SELECT exchange, t_us, value / 60 AS value FROM {duck_increase(duck_stream(_metric), ['exchange', 'symbol'], 60, 60, ['exchange'])}")


def _message_rate(data_type):
    return lambda spark, d: T.event_rate(market_base(spark, d).where(F.col("data_type") == data_type), ["exchange"], MINUTE, STEP[MINUTE], SPAN)


for _number, _type in (("07", "orderbook"), ("08", "trade")):
    add(f"q{_number}_{_type}_rate", _message_rate(_type), f"Q{_number}, TS-2, TS-4, TS-6, TS-13, AGG-1",
        f"{MARKET} " + duck_counts("priced", "timestamp_collector", ["exchange"], MINUTE, f"data_type = '{_type}'", per_second=True))


def _process_instant(metric):
    return lambda spark, d: T.instant(T.vector(process_samples(spark, d, metric), metric, []), [], END_US)


for _number, _name, _metric in (
    ("09", "dropped_total", "collector_messages_dropped_total"), ("10", "queue_depth", "collector_channel_queue_depth"),
    ("16", "rows_buffered", "collector_parquet_rows_buffered"), ("17", "upload_queue", "collector_upload_queue_depth"),
    ("20", "write_errors", "collector_parquet_write_errors_total"), ("21", "upload_failures", "collector_s3_upload_failures_total"),
    ("22", "upload_retries", "collector_s3_upload_retries_total"),
):
    add(f"q{_number}_{_name}", _process_instant(_metric), f"Q{_number}, TS-1", f"{MARKET} SELECT * FROM {duck_instant(duck_process(_metric), [])}")


def _timeouts(spark, d):
    found = message_timeouts(spark, d)
    # One series: that it exists does not depend on a timeout.
    return T.event_count(found, [], HOUR, STEP[HOUR], SPAN, "at_us", spark.range(1))


add("q11_timeouts_1h", _timeouts, "Q11, TS-3, TS-6, TS-13, WIN-3, WIN-4",
    f"{MARKET}, {DUCK_CONFIG}, {DUCK_TIMEOUTS} " + duck_counts("timeouts", "at_us", [], HOUR))

add("q12_circuit_breaks", lambda spark, d: Q.breaker_trips(Q.breaker_checks(parse_frames(landed_frames(spark, d)), "event_id"))
    .agg(F.count("*").alias("value")), "Q12, TS-6, AGG-5", f"WITH RECURSIVE {duck_breaker()} SELECT count(DISTINCT (exchange, symbol, feed, opened_us)) AS value "
    "FROM checks WHERE tripped")


def _quantile(cells, by, window, q, span=None):
    """Quantile at every step whose range has observations: histograms of cells are added where they meet."""
    return T.histogram_quantile(T.to_steps(cells, "__cell_us", window, STEP[window], span), [*by, "t_us"], q)


def _cell(ts, window):
    return T.range_end(ts, math.gcd(window, STEP[window])).alias("__cell_us")


def _latency_quantile(q):
    def run(spark, d):
        events = market_base(spark, d).select("*", _cell("timestamp_collector", FIVE_MINUTES))
        return _quantile(Q.latency_histogram(events, ["exchange", "__cell_us"]), ["exchange"], FIVE_MINUTES, q, SPAN)
    return run


_LATENCY_5M = f"""(SELECT exchange, t_us, le, cumulative FROM ({duck_histogram(
    f'(SELECT * FROM priced JOIN {duck_steps(FIVE_MINUTES)} ON timestamp_collector > t_us - 300000000 AND timestamp_collector <= t_us)',
    'exchange, t_us', LATENCY, Q.LATENCY_BOUNDS_MS)}))"""

for _number, _q in (("13", 0.50), ("14", 0.95)):
    add(f"q{_number}_latency_p{int(_q * 100)}", _latency_quantile(_q), f"Q{_number}, TS-4, TS-6, TS-9, TS-13, AGG-3",
        f"{MARKET} SELECT * FROM {duck_quantile(_LATENCY_5M, ['exchange', 't_us'], f'{_q}::DOUBLE')}")

add("q15_rows_written_rate", lambda spark, d: T.event_rate(market_base(spark, d), [], MINUTE, STEP[MINUTE], SPAN, series=spark.range(1)), "Q15, TS-4, TS-13",
    f"{MARKET} " + duck_counts("priced", "timestamp_collector", [], MINUTE, per_second=True))

add("q18_files_rotated", lambda spark, d: rotated(spark, d).agg(F.count("*").alias("value")), "Q18, TS-6, WIN-7, SNK-2",
    f"WITH RECURSIVE {DUCK_EXPECTED}, {duck_files()} SELECT count(*) AS value FROM opened")

add("q19_rows_written", lambda spark, d: market_base(spark, d).agg(F.count("*").alias("value")), "Q19, TS-1, AGG-4",
    f"{MARKET} SELECT count(*) AS value FROM priced")


def _upload_quantile(q):
    def run(spark, d):
        uploads = upload_log(spark, d).select("*", _cell("ts_us", FIVE_MINUTES))
        return _quantile(Q.histogram(uploads, ["__cell_us"], F.col("duration_s"), Q.UPLOAD_BOUNDS_S), [], FIVE_MINUTES, q)
    return run


# The uploads' own steps: every multiple of the step that a range with an upload ends at.
_UPLOAD_STEPS = f"""(SELECT DISTINCT unnest(range((ts_us + {STEP[FIVE_MINUTES] * 1_000_000 - 1}) // {STEP[FIVE_MINUTES] * 1_000_000} * {STEP[FIVE_MINUTES] * 1_000_000},
  ts_us + 300000000, {STEP[FIVE_MINUTES] * 1_000_000})) AS t_us FROM uploads)"""
_UPLOADS_5M = f"""(SELECT t_us, le, cumulative FROM ({duck_histogram(
    f'(SELECT uploads.*, t_us FROM uploads JOIN {_UPLOAD_STEPS} ON ts_us > t_us - 300000000 AND ts_us <= t_us)',
    't_us', 'duration_s', Q.UPLOAD_BOUNDS_S)}))"""

for _number, _q in (("23", 0.50), ("24", 0.95)):
    add(f"q{_number}_upload_p{int(_q * 100)}", _upload_quantile(_q), f"Q{_number}, TS-9, TS-13, AGG-9",
        f"WITH {DUCK_UPLOADS} SELECT * FROM {duck_quantile(_UPLOADS_5M, ['t_us'], f'{_q}::DOUBLE')}")

add("q25_uptime", lambda spark, d: T.age(_process_instant("collector_start_timestamp_seconds")(spark, d), END_US), "Q25, TS-10",
    f"{MARKET} SELECT {END_US / 1e6} - value AS value FROM {duck_instant(duck_process('collector_start_timestamp_seconds'), [])}")


def _message_counter_rate(spark, d):
    keys = ["exchange", "symbol", "data_type"]
    vec = T.vector(message_samples(market_base(spark, d)), "collector_messages_received_total", keys)
    return rounded(T.rate(vec, keys, FIVE_MINUTES, MINUTE, by=["exchange", "data_type"]))


_COUNTER = f"""(SELECT exchange, symbol, data_type, ts_us, CAST(sum(arrived) OVER (PARTITION BY exchange, symbol, data_type ORDER BY ts_us) AS DOUBLE) AS value
  FROM {duck_scrapes('priced', ['exchange', 'symbol', 'data_type'])})"""
add("message_counter_rate", _message_counter_rate, "SRC-4, TS-3, TS-4, TS-6, TS-13",
    f"""{MARKET} SELECT exchange, data_type, t_us, round(value / 300, 6) AS value
FROM {duck_increase(_COUNTER, ['exchange', 'symbol', 'data_type'], 300, 60, ['exchange', 'data_type'])}""")

# --- hosts ------------------------------------------------------------------------------------


def _labels(metric):
    return ["instance", *series_of(metric)[0]]


def node(spark, d, metric, where=()):
    return T.vector(node_samples(spark, d, metric), metric, _labels(metric), where)


def node_instant(spark, d, metric, where=()):
    return T.instant(node(spark, d, metric, where), _labels(metric), END_US)


def _irate(metric, where=(), step=FIVE_MINUTES):
    return lambda spark, d: T.irate(node(spark, d, metric, where), _labels(metric), FIVE_MINUTES, step)


_CPU = "node_cpu_seconds_total"
_IDLE = [("mode", "=", "idle")]


def _cpu_usage(spark, d):
    idle = T.avg_by(_irate(_CPU, _IDLE)(spark, d))
    return rounded(idle.withColumn("value", 100 - F.col("value") * 100))


add("q26_cpu_usage", _cpu_usage, "Q26, TS-5, TS-7",
    f"""SELECT t_us, round(100 - avg(value) * 100, 6) AS value
FROM {duck_irate(duck_node(_CPU), _labels(_CPU), 300, 300, "mode = 'idle'")} GROUP BY t_us""")


def _memory(name):
    return f"node_memory_{name}_bytes"


def _memory_usage(spark, d):
    labels = ["instance"]
    parts = [node_instant(spark, d, _memory(name)) for name in ("Buffers", "Cached", "MemFree")]
    summed = T.combine(T.combine(parts[0], parts[1], labels, lambda a, b: a + b), parts[2], labels, lambda a, b: a + b)
    available = T.either(node_instant(spark, d, _memory("MemAvailable")), summed, labels)
    return T.combine(available, node_instant(spark, d, _memory("MemTotal")), labels, lambda a, b: 100 * (1 - a / b))


def _duck_memory(name, alias):
    return f"{duck_instant(duck_node(_memory(name)), ['instance'])} {alias}"


add("q27_memory_usage", _memory_usage, "Q27, TS-11, TS-12",
    f"""SELECT t.instance, 100 * (1 - coalesce(a.value, b.value + c.value + f.value) / t.value) AS value
FROM {_duck_memory('MemTotal', 't')} JOIN {_duck_memory('Buffers', 'b')} USING (instance) JOIN {_duck_memory('Cached', 'c')} USING (instance)
JOIN {_duck_memory('MemFree', 'f')} USING (instance) LEFT JOIN {_duck_memory('MemAvailable', 'a')} USING (instance)""")

_SIZE, _AVAIL = "node_filesystem_size_bytes", "node_filesystem_avail_bytes"
# Label patterns of the panels.
_ROOT = [("mountpoint", "=", "/"), ("fstype", "!=", "rootfs")]
_REAL = [("fstype", "!~", "tmpfs|overlay|squashfs")]


def _file_system(where, operation):
    def run(spark, d):
        size, available = node_instant(spark, d, _SIZE, where), node_instant(spark, d, _AVAIL, where)
        return T.combine(available, size, _labels(_SIZE), operation)
    return run


def _duck_file_system(where, value):
    a, s = (duck_instant(duck_node(metric), _labels(metric), where) for metric in (_AVAIL, _SIZE))
    return f"SELECT instance, mountpoint, fstype, {value} AS value FROM {a} a JOIN {s} s USING (instance, mountpoint, fstype)"


_DUCK_REAL = "fstype NOT IN ('tmpfs', 'overlay', 'squashfs')"
add("q28_root_disk_free", _file_system(_ROOT, lambda a, s: 100 * (a / s)), "Q28, TS-2, TS-11",
    _duck_file_system("mountpoint = '/' AND fstype <> 'rootfs'", "100 * (a.value / s.value)"))
add("q43_disk_used", _file_system(_REAL, lambda a, s: s - a), "Q43, TS-2, TS-11", _duck_file_system(_DUCK_REAL, "s.value - a.value"))
add("q44_disk_free_ratio", _file_system(_REAL, lambda a, s: a / s), "Q44, TS-2, TS-11", _duck_file_system(_DUCK_REAL, "a.value / s.value"))

add("q29_host_uptime", lambda spark, d: T.age(node_instant(spark, d, "node_boot_time_seconds"), END_US), "Q29, TS-10",
    f"SELECT instance, {END_US / 1e6} - value AS value FROM {duck_instant(duck_node('node_boot_time_seconds'), ['instance'])}")

add("q30_cpu_by_mode", lambda spark, d: rounded(T.avg_by(_irate(_CPU)(spark, d), ["mode"])), "Q30, TS-5, TS-7",
    f"SELECT mode, t_us, round(avg(value), 6) AS value FROM {duck_irate(duck_node(_CPU), _labels(_CPU), 300, 300)} GROUP BY ALL")


def _node_instant(metric):
    return lambda spark, d: node_instant(spark, d, metric)


for _number, _name, _metric in (
    ("31", "load1", "node_load1"), ("32", "load5", "node_load5"), ("33", "load15", "node_load15"),
    ("36", "memory_buffers", _memory("Buffers")), ("37", "memory_cached", _memory("Cached")), ("38", "memory_free", _memory("MemFree")),
    ("39", "memory_total", _memory("MemTotal")), ("40", "memory_available", _memory("MemAvailable")),
):
    add(f"q{_number}_{_name}", _node_instant(_metric), f"Q{_number}, TS-1",
        f"SELECT * FROM {duck_instant(duck_node(_metric), ['instance'])}")

for _number in ("34", "41"):
    add(f"q{_number}_cpu_cores", lambda spark, d: T.count_by(node_instant(spark, d, _CPU, _IDLE)), f"Q{_number}, TS-8",
        f"""SELECT count(*) AS value FROM {duck_instant(duck_node(_CPU), _labels(_CPU), "mode = 'idle'")}""")


def _difference(left, right):
    return lambda spark, d: T.combine(node_instant(spark, d, left), node_instant(spark, d, right), ["instance"], lambda a, b: a - b)


for _number, _name, _left, _right in (
    ("35", "memory_used", _memory("MemTotal"), _memory("MemAvailable")), ("42", "swap_used", _memory("SwapTotal"), _memory("SwapFree")),
):
    add(f"q{_number}_{_name}", _difference(_left, _right), f"Q{_number}, TS-11",
        f"""SELECT instance, a.value - b.value AS value FROM {duck_instant(duck_node(_left), ['instance'])} a
JOIN {duck_instant(duck_node(_right), ['instance'])} b USING (instance)""")

# Fixed value: label pattern of the panels.
_NOT_VIRTUAL = [("device", "!~", "lo|veth.*|docker.*|br-.*")]
for _number, _name, _metric in (
    ("45", "network_bytes_in", "node_network_receive_bytes_total"), ("46", "network_bytes_out", "node_network_transmit_bytes_total"),
    ("47", "network_packets_in", "node_network_receive_packets_total"), ("48", "network_packets_out", "node_network_transmit_packets_total"),
):
    add(f"q{_number}_{_name}", _irate(_metric, _NOT_VIRTUAL), f"Q{_number}, TS-2, TS-5",
        "SELECT * FROM " + duck_irate(duck_node(_metric), _labels(_metric), 300, 300,
                                      "NOT regexp_full_match(device, 'lo|veth.*|docker.*|br-.*')"))

# --- stored samples ---------------------------------------------------------------------------

# Seconds for which the gauge of the last receipt is scraped after it.
_HORIZON = 1800


def _latest_receipts(spark, d):
    """The gauge at the last receipt of all, from stored samples; series silent for longer than the scrapes are stale."""
    root, rows = work_folder(spark, "samples"), market_base(spark, d)
    write_samples(last_message_samples(rows, _HORIZON), root)
    at_us = rows.agg(F.max("timestamp_collector")).first()[0]
    return instant_of(read_samples(spark, root), "collector_last_message_timestamp_seconds", ["exchange", "symbol"], at_us or 0)


add("stored_latest_receipts", _latest_receipts, "TS-1, TS-2, Q02", f"""WITH {DUCK_MARKET},
seen AS (SELECT exchange, symbol, (timestamp_collector + 14999999) // 15000000 * 15000000 AS first_us, max(timestamp_collector) AS last_us FROM priced GROUP BY ALL),
samples AS (SELECT exchange, symbol, first_us + n * 15000000 AS ts_us, max(last_us) AS last_us FROM seen CROSS JOIN range({_HORIZON // 15}) AS r(n) GROUP BY ALL)
SELECT exchange, symbol, CAST(arg_max(last_us // 1000000, ts_us) AS DOUBLE) AS value FROM samples
CROSS JOIN (SELECT max(timestamp_collector) AS at_us FROM priced) WHERE ts_us <= at_us AND ts_us > at_us - 300000000 GROUP BY ALL""")
