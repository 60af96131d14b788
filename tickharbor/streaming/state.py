"""Stateful streams: duplicates, sequence checks, sessions, parse-error windows."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickharbor.functions.scalars import numeric_sequence
from tickharbor.operators.ordered import Previous, with_previous
from tickharbor.operators.quality import (
    BREAKER_MIN_SAMPLES, BREAKER_RATIO, BREAKER_WINDOW_SECONDS, dead_after_us)
from tickharbor.schemas import STREAM_KEY, WRITER_KEY
from tickharbor.session import remove_folder

WATERMARK = "1 minute"


def with_receipt_time(rows: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Receipt as a timestamp with a watermark. Venue time is unsuitable: 0 means unknown."""
    return rows.withColumn("receipt_time", F.timestamp_micros("timestamp_collector")).withWatermark("receipt_time", watermark)


def closing_row(rows: DataFrame, seconds: int) -> DataFrame:
    """The latest row again, ``seconds`` later: landed as the last one, it closes all windows and sessions before.

    The watermark passes everything that is open; the row's own window stays open and is
    never emitted. ``seconds`` must exceed the watermark's delay and the longest window or gap.
    """
    last = rows.orderBy(F.desc("timestamp_collector")).limit(1)
    return last.withColumn("timestamp_collector", F.col("timestamp_collector") + seconds * 1_000_000)


def drop_duplicates(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """One row per (key, sequence id) among rows whose receipts are within the watermark of each other.

    Which copy stays is not defined; :func:`tickharbor.operators.quality.first_arrivals`
    decides it for a finished table.
    """
    return with_receipt_time(events, watermark).dropDuplicatesWithinWatermark([*WRITER_KEY, "exchange_sequence_id"])


def parse_error_stream(
    parsed: DataFrame, window_seconds: int = BREAKER_WINDOW_SECONDS, ratio: float = BREAKER_RATIO,
    min_samples: int = BREAKER_MIN_SAMPLES, keys: list[str] = STREAM_KEY, watermark: str = WATERMARK,
) -> DataFrame:
    """Error share per window. A window is emitted once the watermark has passed its end.

    Every parsed row moves the watermark, whatever its kind.
    """
    counted = with_receipt_time(parsed, watermark).where(F.col("kind").isin("orderbook", "trade", "error"))
    totals = counted.groupBy(*keys, F.window("receipt_time", f"{window_seconds} seconds").alias("w")).agg(
        F.count_if(F.col("kind") == "error").alias("errors"), F.count("*").alias("samples"))
    share = F.col("errors") / F.col("samples")
    return totals.select(
        *keys, F.unix_micros("w.start").alias("window_us"), "errors", "samples", share.alias("error_ratio"),
        ((F.col("samples") >= min_samples) & (share >= ratio) & (F.col("errors") > 0)).alias("tripped"))


def session_stream(frames: DataFrame, keys: list[str] = STREAM_KEY, watermark: str = WATERMARK) -> DataFrame:
    """Connection sessions. One is emitted once the watermark has passed its end, so an open one is not."""
    gap = F.concat(F.expr("CAST(dead_after_us div 1000000 AS STRING)"), F.lit(" seconds"))
    timed = with_receipt_time(frames.withColumn("dead_after_us", dead_after_us()), watermark)
    return timed.groupBy(*keys, F.session_window("receipt_time", gap).alias("w")).agg(
        F.min("timestamp_collector").alias("opened_us"), F.max("timestamp_collector").alias("closed_us"),
        F.count("*").alias("frames")).drop("w")


def _marks(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """The highest id of each key after the batch before; none before the first batch."""
    return spark.read.schema(schema).parquet(f"{path}/batch={batch_id - 1}") if batch_id else spark.createDataFrame([], schema)


def sequence_stream(
    events: DataFrame, tiebreak: str, path: str, checkpoint: str, trigger: dict | None = None,
) -> StreamingQuery:
    """Sequence checks of a stream; every row gets a result, however late it arrives.

    Rows are answered in the order of their micro-batches, and within one in the order of
    their receipt. The highest id of each key is a table of one row per key under
    ``path/marks``; results are under ``path/checked``. A batch reads the marks that the one
    before has left and overwrites its own folders, so one that is repeated gives the same.
    Older marks are removed. The batch is held on the executors' disks, so its rows are made once.
    """
    numbered = events.select(
        *WRITER_KEY, "timestamp_collector", tiebreak, numeric_sequence("exchange_sequence_id").alias("sequence"),
    ).where(F.col("sequence").isNotNull())
    shape = ", ".join(f"{key} string" for key in WRITER_KEY) + ", highest bigint"

    def check(arrived: DataFrame, batch_id: int) -> None:
        batch = arrived.persist(StorageLevel.DISK_ONLY)
        try:
            check_held(batch, batch_id)
        finally:
            batch.unpersist()
        remove_folder(arrived.sparkSession, f"{path}/marks/batch={batch_id - 2}")

    def check_held(batch: DataFrame, batch_id: int) -> None:
        marks = _marks(batch.sparkSession, f"{path}/marks", batch_id, shape)
        marked = with_previous(batch, WRITER_KEY, ["timestamp_collector", tiebreak], {"__within": Previous("max", "sequence")})
        before = F.greatest("__within", "highest")
        ahead = F.col("sequence") - 1 > before
        result = F.when(before.isNull(), "first").when(F.col("sequence") == before, "duplicate") \
            .when(F.col("sequence") < before, "out_of_order").when(ahead, "gap").otherwise("ok")
        gap = F.when(ahead, F.col("sequence") - 1 - before).otherwise(0)
        marked.join(marks, WRITER_KEY, "left").select(*numbered.columns, result.alias("result"), gap.alias("gap_size")) \
            .write.mode("overwrite").parquet(f"{path}/checked/batch={batch_id}")
        reached = batch.groupBy(*WRITER_KEY).agg(F.max("sequence").alias("highest"))
        marks.unionByName(reached).groupBy(*WRITER_KEY).agg(F.max("highest").alias("highest")) \
            .write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")

    return numbered.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()


def checked_rows(spark: SparkSession, path: str, tiebreak: str) -> DataFrame:
    """What a sequence stream has written under ``path``."""
    keys = ", ".join(f"{key} string" for key in WRITER_KEY)
    shape = f"{keys}, timestamp_collector bigint, {tiebreak} bigint, sequence bigint, result string, gap_size bigint"
    return spark.read.schema(shape).parquet(f"{path}/checked").drop("batch")
