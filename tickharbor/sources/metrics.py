"""Metric samples: what a scrape of the counters and gauges every 15 seconds would have seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.functions.scalars import utc_date, whole
from tickharbor.operators.ordered import Previous, with_previous
from tickharbor.operators.timeseries import instant, range_end, vector
from tickharbor.schemas import WRITER_KEY
from tickharbor.session import configure

# Fixed value: seconds between scrapes.
SCRAPE_SECONDS = 15
SECOND = 1_000_000


def scrape_times(rows: DataFrame, keys: list[str], horizon_s: int, scrape_s: int = SCRAPE_SECONDS, ts: str = "timestamp_collector") -> DataFrame:
    """Scrapes per key: the first one after each row, and those of the following ``horizon_s`` seconds.

    Column ``arrived`` counts the rows that the scrape is the first to see. Rows are
    counted per key and scrape before they are spread over the horizon.
    """
    step = scrape_s * SECOND
    seen = rows.groupBy(*keys, range_end(ts, scrape_s).alias("first_us")).agg(F.count("*").alias("n"))
    offsets = F.sequence(F.lit(0).cast("bigint"), F.lit((horizon_s - 1) * SECOND).cast("bigint"), F.lit(step).cast("bigint"))
    spread = seen.select(*keys, "first_us", "n", F.explode(offsets).alias("offset"))
    return spread.groupBy(*keys, (F.col("first_us") + F.col("offset")).alias("ts_us")).agg(
        F.sum(F.when(F.col("offset") == 0, F.col("n")).otherwise(0)).alias("arrived"))


def labels_of(columns: list[str]):
    if not columns:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.create_map(*[part for name in columns for part in (F.lit(name), F.col(name).cast("string"))])


def counter_samples(events: DataFrame, metric: str, keys: list[str] = WRITER_KEY, horizon_s: int = 120, hot_rows: int | None = None) -> DataFrame:
    """Samples of a counter of rows per key: the running count at each scrape."""
    scrapes = scrape_times(events, keys, horizon_s)
    counted = with_previous(scrapes, keys, ["ts_us"], {"total": Previous("sum", "arrived")}, hot_rows)
    return counted.select(
        "ts_us", F.lit(metric).alias("metric"), labels_of(keys).alias("labels"), F.col("total").cast("double").alias("value"))


def message_samples(events: DataFrame, horizon_s: int = 120) -> DataFrame:
    return counter_samples(events, "collector_messages_received_total", WRITER_KEY, horizon_s)


def last_message_samples(events: DataFrame, horizon_s: int = 120) -> DataFrame:
    """Gauge of the last receipt, in whole seconds, at each scrape."""
    keys = ["exchange", "symbol"]
    step = SCRAPE_SECONDS * SECOND
    last = events.groupBy(*keys, range_end("timestamp_collector", SCRAPE_SECONDS).alias("first_us")).agg(
        F.max("timestamp_collector").alias("last_us"))
    offsets = F.sequence(F.lit(0).cast("bigint"), F.lit((horizon_s - 1) * SECOND).cast("bigint"), F.lit(step).cast("bigint"))
    seen = last.select(*keys, "last_us", "first_us", F.explode(offsets).alias("offset"))
    at_scrape = seen.groupBy(*keys, (F.col("first_us") + F.col("offset")).alias("ts_us")).agg(F.max("last_us").alias("last_us"))
    return at_scrape.select(
        "ts_us", F.lit("collector_last_message_timestamp_seconds").alias("metric"), labels_of(keys).alias("labels"),
        whole("last_us", SECOND).cast("double").alias("value"))


# --- stored samples ---------------------------------------------------------------------------

# Fixed value: seconds after which a series without a new sample is no longer shown.
STALE_SECONDS = 300
_SAMPLE = "ts_us bigint, labels map<string,string>, value double"


def write_samples(samples: DataFrame, root: str, write_mode: str = "append") -> None:
    """Write samples under ``metric=../date=..`` folders, in order of time within a file.

    Rows are rebalanced by folder, so a metric or day of any size is written by as many tasks as it needs.
    """
    folders = ["metric", "date"]
    dated = samples.select("metric", utc_date("ts_us").alias("date"), "ts_us", "labels", "value")
    dated.hint("rebalance", *folders).sortWithinPartitions(*folders, "ts_us") \
        .write.mode(write_mode).option("compression", "zstd").partitionBy(*folders).parquet(root)


def read_samples(spark: SparkSession, root: str) -> DataFrame:
    """The samples written by :func:`write_samples`; filters on metric and date prune folders."""
    return configure(spark).read.schema(f"{_SAMPLE}, metric string, date string").parquet(root)


def instant_of(
    samples: DataFrame, metric: str, labels: list[str], at_us: int, where: list[tuple[str, str, str]] = (), lookback_s: int = STALE_SECONDS,
) -> DataFrame:
    """The latest sample of every series of a stored metric in ``(at - lookback, at]``; older series are stale and have no row.

    Only the folders of the metric and of the days that the bound touches are read, however long the history is.
    """
    first, last = (utc_date(F.lit(us).cast("bigint")) for us in (at_us - lookback_s * SECOND, at_us))
    recent = samples.where((F.col("date") >= first) & (F.col("date") <= last))
    return instant(vector(recent, metric, labels, where), labels, at_us, lookback_s)
