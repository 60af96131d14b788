"""Metric samples, upload logs and listings derived from the generic test tables.

A scrape happens at the 15-second marks of the two minutes after every event. What a
metric showed there is an integer formula of the scrape time, the host and the series,
so that Spark and the comparison engine get the same sample from the same event.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.session import configure
from tickharbor.sources.metrics import scrape_times
from tickharbor.sources.sample_market import events_table, market_base

HORIZON_SECONDS = 120
HOSTS = 3

# The metric and label names that dashboards ask for. The formulas are made up.
# Metric: (labels of its series, formula). s is the scrape time in seconds, h the host, i the series.
# Counters start again every day, at another hour on each host.
_COUNTER = "((s + h * 7200) % 86400) * (i + 2)"
_DEVICES = {"device": ["eth0", "eth1", "lo", "veth12", "docker0"]}
_MOUNTS = {"mountpoint,fstype": ["/,ext4", "/data,xfs", "/run,tmpfs", "/,rootfs", "/img,squashfs"]}
NODE_METRICS: dict[str, tuple[dict[str, list[str]], str]] = {
    "node_cpu_seconds_total": ({"cpu": ["0", "1"], "mode": ["idle", "user", "system"]},
                               "((s + h * 7200) % 86400) * (i + 1) - (s % 45) + 45"),
    "node_load1": ({}, "s % 7 + h"),
    "node_load5": ({}, "s % 11 + h"),
    "node_load15": ({}, "s % 13 + h"),
    "node_boot_time_seconds": ({}, "1704000000 + h"),
    "node_memory_MemTotal_bytes": ({}, "16000000000 + h"),
    "node_memory_MemAvailable_bytes": ({}, "4000000000 + (s % 97) * 1000000"),
    "node_memory_MemFree_bytes": ({}, "1000000000 + (s % 89) * 1000000"),
    "node_memory_Buffers_bytes": ({}, "200000000 + (s % 83) * 1000000"),
    "node_memory_Cached_bytes": ({}, "2000000000 + (s % 79) * 1000000"),
    "node_memory_SwapTotal_bytes": ({}, "8000000000"),
    "node_memory_SwapFree_bytes": ({}, "7000000000 + (s % 73) * 1000000"),
    "node_filesystem_size_bytes": (_MOUNTS, "500000000000 + i"),
    "node_filesystem_avail_bytes": (_MOUNTS, "100000000000 + (s % 71) * 1000000 + i"),
    "node_network_receive_bytes_total": (_DEVICES, _COUNTER),
    "node_network_transmit_bytes_total": (_DEVICES, _COUNTER),
    "node_network_receive_packets_total": (_DEVICES, _COUNTER),
    "node_network_transmit_packets_total": (_DEVICES, _COUNTER),
}
# A host without this metric takes the sum of the others in its place.
WITHOUT_AVAILABLE_MEMORY = 2

PROCESS_METRICS: dict[str, str] = {
    "collector_messages_dropped_total": "s % 9",
    "collector_channel_queue_depth": "s % 61",
    "collector_parquet_rows_buffered": "s % 1000",
    "collector_upload_queue_depth": "s % 5",
    "collector_parquet_write_errors_total": "s % 3",
    "collector_s3_upload_failures_total": "s % 4",
    "collector_s3_upload_retries_total": "s % 17",
    "collector_start_timestamp_seconds": "1704067200",
}
STREAM_METRICS: dict[str, str] = {
    "collector_websocket_pings_sent_total": "((s % 86400) - (s % 20)) / 20",
    "collector_websocket_pongs_received_total": "((s % 86400) - (s % 30)) / 30",
}


def series_of(metric: str) -> list[dict[str, str]]:
    """All label sets of a node metric, in the order of their series number."""
    labels, _ = NODE_METRICS[metric]
    names = [part for name in labels for part in name.split(",")]
    return [
        dict(zip(names, (part for value in values for part in value.split(",")), strict=True))
        for values in product(*labels.values())
    ]


def _text_map(labels: dict[str, str]):
    return F.create_map(*[F.lit(part) for item in labels.items() for part in item])


def node_samples(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """Samples of one host metric, labelled with the host and the labels of the series."""
    hosts = events_table(spark, sf_dir).select(
        (F.col("user_id") % HOSTS).alias("h"), F.expr("unix_micros(CAST(ts AS TIMESTAMP))").alias("timestamp_collector"))
    scrapes = scrape_times(hosts, ["h"], HORIZON_SECONDS)
    if metric == "node_memory_MemAvailable_bytes":
        scrapes = scrapes.where(F.col("h") != WITHOUT_AVAILABLE_MEMORY)
    series = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("i"), _text_map({"job": "node-exporter", **labels}).alias("own"))
        for i, labels in enumerate(series_of(metric))])
    spread = scrapes.select("ts_us", "h", F.expr("ts_us div 1000000").alias("s"), F.inline(series))
    labels = F.map_concat("own", F.create_map(F.lit("instance"), F.concat(F.lit("host"), F.col("h").cast("string"))))
    return spread.select(
        "ts_us", F.lit(metric).alias("metric"), labels.alias("labels"),
        F.expr(NODE_METRICS[metric][1]).cast("double").alias("value"))


def process_samples(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """Samples of a process-wide metric, without labels."""
    scrapes = scrape_times(market_base(spark, sf_dir), [], HORIZON_SECONDS).withColumn("s", F.expr("ts_us div 1000000"))
    return scrapes.select(
        "ts_us", F.lit(metric).alias("metric"), F.expr("CAST(map() AS MAP<STRING,STRING>)").alias("labels"),
        F.expr(PROCESS_METRICS[metric]).cast("double").alias("value"))


def stream_samples(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """Samples of a metric per venue and symbol."""
    keys = ["exchange", "symbol"]
    scrapes = scrape_times(market_base(spark, sf_dir), keys, HORIZON_SECONDS).withColumn("s", F.expr("ts_us div 1000000"))
    labels = F.create_map(*[part for key in keys for part in (F.lit(key), F.col(key))])
    return scrapes.select(
        "ts_us", F.lit(metric).alias("metric"), labels.alias("labels"),
        F.expr(STREAM_METRICS[metric]).cast("double").alias("value"))


def upload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order stands for one finished upload."""
    orders = configure(spark).read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.concat(F.lit("file/"), F.col("o_orderkey").cast("string")).alias("relative_path"),
        F.expr("unix_micros(CAST(o_orderdate AS TIMESTAMP)) + (o_orderkey * 37 % 86400) * 1000000").alias("ts_us"),
        F.when(F.col("o_orderstatus") == "F", "failure").otherwise("success").alias("status"),
        (F.expr("CAST(round(o_totalprice) AS BIGINT) % 70000") / 1000).alias("duration_s"),
        (F.col("o_orderkey") % 3).alias("retries"))


def local_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order stands for one file; its rows are the line items."""
    items = configure(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    return items.groupBy("l_orderkey").agg(
        F.count("*").alias("rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("size")).select(
        F.col("l_orderkey").alias("file_id"),
        F.concat(F.lit("file/"), F.col("l_orderkey").cast("string")).alias("relative_path"), "rows", "size")


def remote_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as listed after the upload: some missing, some cut short, some unknown."""
    listed = local_manifest(spark, sf_dir).where(F.col("file_id") % 10 != 3)
    size = F.when(F.col("file_id") % 7 == 0, F.col("size") - 1).otherwise(F.col("size"))
    path = F.when(F.col("file_id") % 11 == 5, F.concat("relative_path", F.lit(".tmp"))).otherwise(F.col("relative_path"))
    return listed.select(path.alias("relative_path"), size.alias("size"))


def sample_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A market configuration: the symbols seen per venue, some of them left out or asked for oddly."""
    seen = market_base(spark, sf_dir).where("NOT (exchange = 'coinbase' AND base = 'XRP')") \
        .groupBy("exchange").agg(F.array_sort(F.collect_set("native_symbol")).alias("symbols"))
    return seen.select(
        "exchange", "symbols",
        F.expr("CASE exchange WHEN 'upbit' THEN array('trades', 'ticker') WHEN 'okx' THEN array('orderbook', 'trade') "
               "WHEN 'binance' THEN NULL ELSE array('orderbook', 'trades') END").alias("feeds"),
        F.expr("CASE exchange WHEN 'bybit' THEN 200L WHEN 'okx' THEN 200L END").alias("data_timeout_secs"))


# --- the same derivations for the comparison engine ---------------------------------------------

def duck_scrapes(source: str, keys: list[str]) -> str:
    """Query for (keys, ts_us, s, arrived); ``source`` has the keys and timestamp_collector."""
    listed = ", ".join(keys) + ", " if keys else ""
    group = f"GROUP BY {', '.join([*keys, 'ts_us'])}"
    return f"""(SELECT {listed}ts_us, ts_us // 1000000 AS s, CAST(sum(n) AS BIGINT) AS arrived FROM (
        SELECT {listed}(timestamp_collector + 14999999) // 15000000 * 15000000 + k * 15000000 AS ts_us,
          CASE WHEN k = 0 THEN 1 ELSE 0 END AS n
        FROM {source} CROSS JOIN (SELECT unnest(range(0, {HORIZON_SECONDS // 15})) AS k)) {group})"""


def duck_node(metric: str) -> str:
    """Query for (instance, labels..., ts_us, value) of a host metric."""
    series = series_of(metric)
    names = list(series[0])
    values = ", ".join(f"({i}{''.join(', ' + repr(v) for v in labels.values())})" for i, labels in enumerate(series))
    columns = "".join(f", {name}" for name in names)
    scrapes = duck_scrapes("(SELECT user_id % 3 AS h, epoch_us(ts) AS timestamp_collector FROM events)", ["h"])
    only = f" WHERE h <> {WITHOUT_AVAILABLE_MEMORY}" if metric == "node_memory_MemAvailable_bytes" else ""
    return f"""(SELECT 'host' || h AS instance{columns}, ts_us, CAST({NODE_METRICS[metric][1]} AS DOUBLE) AS value
        FROM {scrapes} CROSS JOIN (VALUES {values}) AS series(i{columns}){only})"""


def duck_process(metric: str) -> str:
    return f"(SELECT ts_us, CAST({PROCESS_METRICS[metric]} AS DOUBLE) AS value FROM {duck_scrapes('priced', [])})"


def duck_stream(metric: str) -> str:
    return (f"(SELECT exchange, symbol, ts_us, CAST({STREAM_METRICS[metric]} AS DOUBLE) AS value "
            f"FROM {duck_scrapes('priced', ['exchange', 'symbol'])})")


DUCK_UPLOADS = """
uploads AS (SELECT 'file/' || o_orderkey AS relative_path, epoch_us(o_orderdate) + (o_orderkey * 37 % 86400) * 1000000 AS ts_us,
  CASE WHEN o_orderstatus = 'F' THEN 'failure' ELSE 'success' END AS status,
  (CAST(round(o_totalprice) AS BIGINT) % 70000) / 1000.0 AS duration_s, o_orderkey % 3 AS retries FROM orders)
""".strip()

DUCK_FILES = """
manifest AS (SELECT l_orderkey AS file_id, 'file/' || l_orderkey AS relative_path, count(*) AS rows,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS size FROM lineitem GROUP BY l_orderkey),
listing AS (SELECT CASE WHEN file_id % 11 = 5 THEN relative_path || '.tmp' ELSE relative_path END AS relative_path,
  CASE WHEN file_id % 7 = 0 THEN size - 1 ELSE size END AS size FROM manifest WHERE file_id % 10 <> 3)
""".strip()

DUCK_CONFIG = """
streams AS (SELECT DISTINCT exchange, native_symbol, symbol, f AS feed,
  CASE WHEN exchange IN ('bybit', 'okx') THEN 200 END AS data_timeout_secs
  FROM priced CROSS JOIN (VALUES ('orderbook'), ('trades')) AS feeds(f)
  WHERE NOT (exchange = 'coinbase' AND base = 'XRP') AND NOT (exchange = 'upbit' AND f = 'orderbook'))
""".strip()
