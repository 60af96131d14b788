"""Correlating events with the configuration, and files with what was stored.

No join here forces a broadcast. The configuration and status tables are small, and
Spark broadcasts them when their size at run time is below its threshold; otherwise
the join shuffles and adaptive execution splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickharbor.functions.scalars import feed_data_type
from tickharbor.schemas import STREAM_KEY, WRITER_KEY


def expected_counts(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """Message counts for every configured pair and both data types, 0 where nothing arrived."""
    types = F.explode(F.array(F.lit("orderbook"), F.lit("trade"))).alias("data_type")
    expected = pairs.select("exchange", "symbol").distinct().select("*", types)
    counts = events.groupBy(*WRITER_KEY).agg(F.count("*").alias("n"))
    return expected.join(counts, WRITER_KEY, "left").select(*WRITER_KEY, F.coalesce("n", F.lit(0)).alias("messages"))


def configured_events(events: DataFrame, streams: DataFrame) -> DataFrame:
    """Events of configured streams; ``feed`` selects orderbook, trades or both per market."""
    return events.join(streams.select("exchange", "symbol", feed_data_type("feed").alias("data_type")), WRITER_KEY, "left_semi")


def unconfigured_events(events: DataFrame, streams: DataFrame) -> DataFrame:
    return events.join(streams.select("exchange", "symbol", feed_data_type("feed").alias("data_type")), WRITER_KEY, "left_anti")


def verify_copies(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Compare a manifest with a listing of the copies by path and size."""
    ours = local.select("relative_path", F.col("size").alias("local_size"))
    theirs = remote.select("relative_path", F.col("size").alias("remote_size"))
    return ours.join(theirs, "relative_path", "full_outer").select(
        "relative_path", "local_size", "remote_size",
        F.when(F.col("remote_size").isNull(), "missing")
        .when(F.col("local_size").isNull(), "unexpected")
        .when(F.col("local_size") != F.col("remote_size"), "size_mismatch")
        .otherwise("ok").alias("status"))


def deletion_eligibility(manifest: DataFrame) -> DataFrame:
    """Whether a source file may go: ``mode`` with ``upload_ok`` and ``copy_ok`` decides."""
    mode = F.col("mode")
    return manifest.withColumn(
        "deletable",
        F.when(mode == "s3", F.col("upload_ok")).when(mode == "both", F.col("upload_ok") & F.col("copy_ok")).otherwise(F.lit(False)))


def stream_status(streams: DataFrame, frames: DataFrame, at_us: int, timeout_us: int) -> DataFrame:
    """Every configured stream with its last frame and whether it counts as connected at ``at_us``."""
    latest = frames.where(F.col("timestamp_collector") <= at_us).groupBy(*STREAM_KEY).agg(
        F.max("timestamp_collector").alias("last_us"))
    up = F.coalesce(F.lit(at_us) - F.col("last_us") <= timeout_us, F.lit(False))
    return streams.select(*STREAM_KEY).distinct().join(latest, STREAM_KEY, "left").select(
        *STREAM_KEY, "last_us", up.alias("up"))


def health(status: DataFrame, dropped: int = 0) -> DataFrame:
    """Overall state of all streams; the first condition that holds decides."""
    total, up = F.count("*"), F.count_if("up")
    counted = status.agg(total.alias("total"), up.alias("up"), F.lit(dropped).cast("bigint").alias("messages_dropped"))
    partial, pressure = F.col("up") < F.col("total"), F.col("messages_dropped") > 0
    return counted.select(
        "up", "total", "messages_dropped",
        F.when(F.col("total") == 0, "starting").when(F.col("up") == 0, "unhealthy")
        .when(partial | pressure, "degraded").otherwise("healthy").alias("status"),
        F.when((F.col("total") == 0) | (F.col("up") == 0), F.lit(None).cast("string"))
        .when(partial, "partial_connections").when(pressure, "backpressure").alias("degraded_reason"))
