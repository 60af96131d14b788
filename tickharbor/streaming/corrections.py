"""Stateful streams whose results late rows correct: first arrivals, parse-error windows, sessions, the book.

No watermark leaves rows out here. What a micro-batch finds is a table under its batch id; a repeated batch
overwrites its own folder. Results are read over all batches, or as each batch has left them, so a row that
comes a month late changes the window, session or first arrival that it belongs to. The tables grow with the
groups, not with the rows; the streams in :mod:`tickharbor.streaming.state` bound them by a watermark instead.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickharbor.operators.ordered import Previous, key_sizes, with_previous
from tickharbor.operators.payload import AMOUNT, book_of, book_state
from tickharbor.operators.quality import (
    BREAKER_MIN_SAMPLES, BREAKER_RATIO, BREAKER_WINDOW_SECONDS, SECOND, dead_after_us, first_arrivals, sessions)
from tickharbor.schemas import STREAM_KEY, WRITER_KEY
from tickharbor.session import remove_folder

_LAST = 2**63 - 1


def _by_batch(
    rows: DataFrame, made: Callable[[DataFrame, int], DataFrame], path: str, checkpoint: str, trigger: dict | None,
) -> StreamingQuery:
    """Write what ``made`` finds in each micro-batch into the folder of its id.

    The batch is held on the executors' disks meanwhile, so its rows are made once; what a lost
    executor held is made again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.DISK_ONLY)
        try:
            made(held, batch_id).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            held.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()


def schema_text(df: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)


def _strings(keys: list[str]) -> str:
    return ", ".join(f"{key} string" for key in keys)


def _batches(spark: SparkSession, path: str, shape: str) -> DataFrame:
    return spark.read.schema(f"{shape}, batch int").parquet(path)


# --- first arrivals ---------------------------------------------------------------------------

def _order(tiebreak: str) -> Column:
    """Receipt and tiebreak in one number of fixed width; nulls come last."""
    def place(name: str) -> Column:
        return F.coalesce(F.col(name).cast("bigint"), F.lit(_LAST)).cast("decimal(38,0)")

    return (place("timestamp_collector") * F.lit(str(10**19)).cast("decimal(20,0)") + place(tiebreak)).cast("decimal(38,0)")


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[name].eqNullSafe(right[name]) for name in names])


def first_arrival_stream(
    events: DataFrame, tiebreak: str, path: str, checkpoint: str, keys: list[str] = WRITER_KEY, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep one row per (key, sequence id), however far apart its copies come.

    A batch writes the ids that are new, and those whose copy here was received before the one
    kept so far. Of rows equal in receipt and tiebreak one stays. The kept table is read by its
    narrow columns for the ids of the batch alone; it is shuffled only if the batch is too large
    to be broadcast. Read the result with :func:`first_arrival_rows`.
    """
    identity = [*keys, "exchange_sequence_id"]
    shape = schema_text(events)

    def made(batch: DataFrame, batch_id: int) -> DataFrame:
        ordered = batch.withColumn("__order", _order(tiebreak))
        here = ordered.groupBy(*identity).agg(F.min("__order").alias("__first"))
        if batch_id:
            kept = _batches(batch.sparkSession, path, shape).where(F.col("batch") < batch_id)
            kept = kept.select(*identity, _order(tiebreak).alias("__order"))
            before = kept.join(here, _same(kept, here, identity)).select(*[kept[name] for name in identity], "__order") \
                .groupBy(*identity).agg(F.min("__order").alias("__before"))
            here = here.join(before, _same(here, before, identity), "left") \
                .where("__before IS NULL OR __first < __before").select(*[here[name] for name in identity], "__first")
        chosen = ordered.join(here, _same(ordered, here, identity) & (F.col("__order") == F.col("__first")), "left_semi")
        return chosen.dropDuplicates(identity).drop("__order")

    return _by_batch(events, made, path, checkpoint, trigger)


def first_arrival_rows(spark: SparkSession, path: str, shape: str, tiebreak: str, keys: list[str] = WRITER_KEY) -> DataFrame:
    """The first arrivals so far, with the ``batch`` that found each; ``shape`` is the schema of the events."""
    rows = _batches(spark, path, shape)
    # Only what a later batch has replaced is left out; nulls in receipt and tiebreak rank as in the stream.
    ranked = rows.withColumn("__tiebreak", F.coalesce(tiebreak, F.lit(_LAST))).withColumn("__receipt", F.col("timestamp_collector")) \
        .withColumn("timestamp_collector", F.coalesce("timestamp_collector", F.lit(_LAST)))
    return first_arrivals(ranked, "__tiebreak", keys).withColumn("timestamp_collector", F.col("__receipt")).drop("__tiebreak", "__receipt")


# --- parse errors -----------------------------------------------------------------------------

def error_count_stream(
    parsed: DataFrame, path: str, checkpoint: str, window_seconds: int = BREAKER_WINDOW_SECONDS,
    keys: list[str] = STREAM_KEY, trigger: dict | None = None,
) -> StreamingQuery:
    """Errors and samples that each micro-batch adds to each window of each key."""
    width = window_seconds * SECOND
    counted = parsed.where(F.col("kind").isin("orderbook", "trade", "error")).select(
        *keys, "kind", (F.floor(F.col("timestamp_collector") / width) * width).cast("bigint").alias("window_us"))

    def made(batch: DataFrame, _: int) -> DataFrame:
        return batch.groupBy(*keys, "window_us").agg(
            F.count_if(F.col("kind") == "error").alias("errors"), F.count("*").alias("samples"))

    return _by_batch(counted, made, path, checkpoint, trigger)


def _judged(totals: DataFrame, ratio: float, min_samples: int) -> DataFrame:
    share = F.col("errors") / F.col("samples")
    return totals.withColumn("error_ratio", share).withColumn(
        "tripped", (F.col("samples") >= min_samples) & (share >= ratio) & (F.col("errors") > 0))


def error_revisions(
    spark: SparkSession, path: str, ratio: float = BREAKER_RATIO, min_samples: int = BREAKER_MIN_SAMPLES, keys: list[str] = STREAM_KEY,
) -> DataFrame:
    """Each window as each batch that added to it has left it; ``revision`` 0 is the first, the highest is the result."""
    counts = _batches(spark, path, f"{_strings(keys)}, window_us bigint, errors bigint, samples bigint")
    so_far = Window.partitionBy(*keys, "window_us").orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.select(
        *keys, "window_us", "batch", (F.count("*").over(so_far) - 1).alias("revision"),
        F.sum("errors").over(so_far).alias("errors"), F.sum("samples").over(so_far).alias("samples"))
    return _judged(totals, ratio, min_samples)


def error_windows(
    spark: SparkSession, path: str, ratio: float = BREAKER_RATIO, min_samples: int = BREAKER_MIN_SAMPLES, keys: list[str] = STREAM_KEY,
) -> DataFrame:
    """The windows over all batches so far."""
    counts = _batches(spark, path, f"{_strings(keys)}, window_us bigint, errors bigint, samples bigint")
    totals = counts.groupBy(*keys, "window_us").agg(F.sum("errors").alias("errors"), F.sum("samples").alias("samples"))
    return _judged(totals, ratio, min_samples)


# --- sessions ---------------------------------------------------------------------------------

def session_part_stream(
    frames: DataFrame, tiebreak: str, path: str, checkpoint: str, keys: list[str] = STREAM_KEY, trigger: dict | None = None,
) -> StreamingQuery:
    """The sessions within each micro-batch, as parts of those of the whole stream. ``keys`` include the venue."""
    def made(batch: DataFrame, _: int) -> DataFrame:
        return sessions(batch, tiebreak, keys).select(*keys, "opened_us", "closed_us", "frames")

    return _by_batch(frames.select(*keys, "timestamp_collector", tiebreak), made, path, checkpoint, trigger)


def joined_sessions(spark: SparkSession, path: str, keys: list[str] = STREAM_KEY, hot_rows: int | None = None) -> DataFrame:
    """The sessions over all batches so far; parts closer than the venue's dead time are one.

    A part has no silence within it, so the latest end of the parts that opened before decides
    whether one continues them. An open session is there as far as it has got.
    """
    parts = _batches(spark, path, f"{_strings(keys)}, opened_us bigint, closed_us bigint, frames bigint")
    order = ["opened_us", "batch"]  # total: the parts of one batch open at different times
    sizes = key_sizes(parts, keys)
    linked = with_previous(parts, keys, order, {"__closed": Previous("max", "closed_us")}, hot_rows, sizes)
    starts = F.coalesce(F.col("opened_us") - F.col("__closed") > dead_after_us(), F.lit(True)).cast("bigint")
    numbered = with_previous(
        linked.withColumn("__starts", starts), keys, order, {"__session": Previous("sum", "__starts")}, hot_rows, sizes)
    return numbered.groupBy(*keys, "__session").agg(
        F.min("opened_us").alias("opened_us"), F.max("closed_us").alias("closed_us"), F.sum("frames").alias("frames")).drop("__session")


# --- the book ---------------------------------------------------------------------------------

def _book_shape(tiebreak: str) -> str:
    return f"{_strings(WRITER_KEY[:2])}, side string, price {AMOUNT}, size {AMOUNT}, mark boolean, " \
        f"timestamp_collector bigint, {tiebreak} bigint, part int, position int"


def book_stream(events: DataFrame, tiebreak: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Advance the book's state by each micro-batch; no frame is opened twice, however long the history.

    A batch reads the state that the one before has left and writes its own; older ones are removed. The state
    has one row per price level since a symbol's latest snapshot.
    """
    shape = _book_shape(tiebreak)

    def made(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        remove_folder(spark, f"{path}/batch={batch_id - 2}")
        before = spark.read.schema(shape).parquet(f"{path}/batch={batch_id - 1}") if batch_id else None
        return book_state(batch, tiebreak, before)

    return _by_batch(events, made, path, checkpoint, trigger)


def latest_book(spark: SparkSession, path: str, tiebreak: str) -> DataFrame:
    """The book after the latest batch that is written."""
    states = _batches(spark, path, _book_shape(tiebreak))
    newest = states.select(F.max("batch")).first()[0]
    return book_of(states.where(F.col("batch") == F.lit(-1 if newest is None else newest)))
