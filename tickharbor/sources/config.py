"""The market configuration as a table."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.functions.scalars import feed_data_type, feed_name, normalize_symbol
from tickharbor.schemas import MARKET_CONFIG
from tickharbor.venues import VENUES
from tickharbor.venues.subscriptions import api_symbol, stream_channel

# The feeds of a market that names none.
DEFAULT_FEEDS = ["orderbook", "trades"]


def read_market_config(spark: SparkSession, text: str) -> DataFrame:
    """The ``markets`` sections of a TOML document, one row per section."""
    markets = tomllib.loads(text)["markets"]
    rows = [
        (m["exchange"], m["symbols"], m.get("feeds"), m.get("base_url"), m.get("data_timeout_secs"))
        for m in markets
    ]
    return spark.createDataFrame(rows, MARKET_CONFIG)


def market_pairs(config: DataFrame) -> DataFrame:
    """One row per market and symbol; a market without feeds gets both."""
    feeds = F.coalesce("feeds", F.array(*[F.lit(feed) for feed in DEFAULT_FEEDS]))
    return config.select(
        F.lower("exchange").alias("exchange"), F.explode("symbols").alias("native_symbol"), feeds.alias("feeds"),
        *[name for name in ("base_url", "data_timeout_secs") if name in config.columns])


def market_streams(config: DataFrame) -> DataFrame:
    """One row per (venue, symbol, feed). Unknown feed names are left out, after being asked for twice kept once."""
    pairs = market_pairs(config)
    rest = [name for name in pairs.columns if name not in ("feeds",)]
    streams = pairs.select(*rest, F.explode(F.array_distinct(F.transform("feeds", feed_name))).alias("feed"))
    return streams.where(F.col("feed").isNotNull()).withColumn("symbol", normalize_symbol("native_symbol"))


def unknown_feeds(config: DataFrame) -> DataFrame:
    """Configured feed names that mean nothing."""
    pairs = market_pairs(config).select("exchange", "native_symbol", F.explode("feeds").alias("feed_name"))
    return pairs.where(feed_name("feed_name").isNull())


def subscription_plan(streams: DataFrame) -> DataFrame:
    """What to subscribe to per stream: channel and the symbol as the venue spells it."""
    return streams.select(
        "exchange", "native_symbol", "symbol", "feed", feed_data_type("feed").alias("data_type"),
        stream_channel("exchange", "native_symbol", "feed").alias("channel"),
        api_symbol("exchange", "native_symbol").alias("instrument"))


# --- validation -------------------------------------------------------------------------------

def duplicate_pairs(config: DataFrame) -> DataFrame:
    """Markets configured more than once, whatever the case of the symbol."""
    pairs = market_pairs(config).select(F.concat_ws(":", "exchange", F.lower("native_symbol")).alias("pair"))
    return pairs.groupBy("pair").agg(F.count("*").alias("times")).where(F.col("times") > 1)


def distinct_pairs(config: DataFrame) -> DataFrame:
    return market_pairs(config).select(F.concat_ws(":", "exchange", F.lower("native_symbol")).alias("pair")).distinct()


def unsupported_markets(config: DataFrame) -> DataFrame:
    return market_pairs(config).where(~F.col("exchange").isin(*VENUES)).select("exchange", "native_symbol")


def invalid_settings(settings: DataFrame) -> DataFrame:
    """Connection settings that contradict each other, one row per violation.

    ``settings`` has message_timeout_secs, initial_retry_delay_secs and max_retry_delay_secs;
    a NULL counts as 0, as in a configuration without that section.
    """
    def value(name):
        return F.coalesce(F.col(name), F.lit(0))

    timeout, first, most = (value(n) for n in ("message_timeout_secs", "initial_retry_delay_secs", "max_retry_delay_secs"))
    violations = F.array_compact(F.array(
        F.when(first >= timeout, F.lit("initial retry delay not below message timeout")),
        F.when(most < first, F.lit("maximum retry delay below initial delay"))))
    return settings.select("*", F.explode(violations).alias("violation"))


def worker_budget(config: DataFrame) -> DataFrame:
    """Workers (one per pair and configured feed) and the number of events their queue may hold."""
    workers = F.coalesce(F.sum(F.size("feeds")), F.lit(0))
    return market_pairs(config).agg(workers.alias("workers"), (F.greatest(workers, F.lit(1)) * 1000).alias("queue_size"))
