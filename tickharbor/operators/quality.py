"""Data quality of market events: counts, latency, sequences, staleness, sessions, parse errors."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickharbor.functions.scalars import latency_ms, numeric_sequence, whole
from tickharbor.operators.ordered import Previous, key_sizes, with_previous
from tickharbor.operators.rotation import SLICE_ROWS, rotation_files
from tickharbor.schemas import STREAM_KEY, WRITER_KEY
from tickharbor.session import stored
from tickharbor.venues import VENUES

# Upper bounds of the latency histogram in milliseconds.
LATENCY_BOUNDS_MS = [1, 5, 10, 25, 50, 100, 250, 500, 1000, 5000]
# Upper bounds of the upload duration histogram in seconds.
UPLOAD_BOUNDS_S = [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0]
# Fixed value: seconds without any frame after which a connection counts as dead.
DEAD_CONNECTION_SECONDS = 90
# Fixed value: seconds a new subscription may stay silent before a warning.
SUBSCRIPTION_GRACE_SECONDS = 30
# Fixed values of the parse-error breaker.
BREAKER_WINDOW_SECONDS, BREAKER_RATIO, BREAKER_MIN_SAMPLES = 60, 0.5, 100

SECOND = 1_000_000


# --- counts and times -------------------------------------------------------------------------

def message_counts(events: DataFrame, keys: list[str] = WRITER_KEY) -> DataFrame:
    return events.groupBy(*keys).agg(F.count("*").alias("messages"))


def last_message_seconds(events: DataFrame, keys: Iterable[str] = ("exchange", "symbol")) -> DataFrame:
    """Whole second of the latest receipt per key."""
    return events.groupBy(*keys).agg(whole(F.max("timestamp_collector"), SECOND).alias("last_message_s"))


def rows_and_files(archive: DataFrame, path: str = "file_path") -> DataFrame:
    """Rows and files per writer key. Counting per file first keeps the distinct count small."""
    per_file = archive.groupBy(*WRITER_KEY, path).agg(F.count("*").alias("rows"))
    return per_file.groupBy(*WRITER_KEY).agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files"))


# --- histograms -------------------------------------------------------------------------------

def le_label(bound: float) -> str:
    return f"{bound:g}"


def histogram(df: DataFrame, keys: list[str], value: Column, bounds: list[float]) -> DataFrame:
    """Cumulative histogram per key: rows of (keys, le, cumulative), with total count and sum.

    One hash aggregation with a conditional count per bound, then the few result rows
    are unpivoted; the input rows are never multiplied.
    """
    names = [le_label(bound) for bound in bounds] + ["+Inf"]
    measured = df.select(*keys, value.alias("__value")).where(F.col("__value").isNotNull())
    counts = measured.groupBy(*keys).agg(
        *[F.count_if(F.col("__value") <= bound).alias(f"__le{i}") for i, bound in enumerate(bounds)],
        F.count("*").alias("observations"),
        F.sum("__value").alias("total"),
    )
    buckets = [F.struct(F.lit(name).alias("le"), F.col(f"__le{i}" if i < len(bounds) else "observations").alias("cumulative"))
               for i, name in enumerate(names)]
    return counts.select(*keys, "observations", "total", F.inline(F.array(*buckets)))


def latency_histogram(events: DataFrame, keys: list[str] = WRITER_KEY) -> DataFrame:
    """Venue-to-receipt latency in whole ms. Unknown venue times and clock skew take no part."""
    return histogram(events, keys, latency_ms(), LATENCY_BOUNDS_MS)


def upload_histogram(uploads: DataFrame) -> DataFrame:
    return histogram(uploads, ["status"], F.col("duration_s"), UPLOAD_BOUNDS_S)


def upload_summary(uploads: DataFrame) -> DataFrame:
    """Uploads, failures and retries in total."""
    return uploads.agg(
        F.count("*").alias("uploads"), F.count_if(F.col("status") != "success").alias("failures"),
        F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"))


# --- sequences --------------------------------------------------------------------------------

def sequence_check(events: DataFrame, tiebreak: str, keys: list[str] = WRITER_KEY, hot_rows: int | None = None) -> DataFrame:
    """Classify each row against the highest id seen before it in its key.

    An out-of-order row does not lower that mark, so it is a running maximum and not
    the previous row. Rows with a non-numeric id take no part. A gap in depth ids is
    not proof of loss, since a venue may advance them by more than one per message.
    """
    numbered = events.select(
        *keys, "timestamp_collector", tiebreak, numeric_sequence("exchange_sequence_id").alias("sequence")
    ).where(F.col("sequence").isNotNull())
    marked = with_previous(
        numbered, keys, ["timestamp_collector", tiebreak], {"highest_before": Previous("max", "sequence")}, hot_rows)
    current, before = F.col("sequence"), F.col("highest_before")
    return marked.select(
        *keys, "timestamp_collector", tiebreak, "sequence", "highest_before",
        F.when(before.isNull(), "first")
        .when(current == before, "duplicate")
        .when(current < before, "out_of_order")
        .when(current - 1 > before, "gap")
        .otherwise("ok").alias("result"),
        F.when(current - 1 > before, current - 1 - before).otherwise(F.lit(0)).cast("bigint").alias("gap_size"),
    )


def sequence_summary(checked: DataFrame, keys: list[str] = WRITER_KEY) -> DataFrame:
    def n(result: str) -> Column:
        return F.count_if(F.col("result") == result)

    return checked.groupBy(*keys).agg(
        n("gap").alias("gaps"), n("out_of_order").alias("out_of_order"), n("duplicate").alias("duplicates"),
        n("ok").alias("in_order"), F.sum("gap_size").alias("missing"), F.max("gap_size").alias("largest_gap"))


def gap_sizes(checked: DataFrame) -> DataFrame:
    """How often each gap size occurs."""
    return checked.where(F.col("result") == "gap").groupBy("gap_size").agg(F.count("*").alias("gaps"))


def first_arrivals(events: DataFrame, tiebreak: str, keys: list[str] = WRITER_KEY) -> DataFrame:
    """One row per (key, sequence id): the first to arrive. ``tiebreak`` tells rows of one receipt apart.

    Only the identity and the order of a row are aggregated, with receipt and tiebreak packed
    into one number of fixed width, so that it is a hash aggregation that collapses a group of
    copies on the map side. Groups with one row are left out of what is joined: where copies
    are rare that is small, and the rows themselves are neither shuffled nor sorted.
    """
    identity = [*keys, "exchange_sequence_id"]
    order = (F.col("timestamp_collector").cast("decimal(38,0)") * F.lit(str(10**19)).cast("decimal(20,0)")
             + F.col(tiebreak).cast("decimal(38,0)")).cast("decimal(38,0)")
    ordered = events.withColumn("__order", order)
    copies = (ordered.groupBy(*identity).agg(F.count("*").alias("__rows"), F.min("__order").alias("__first"))
              .where("__rows > 1").select(*[F.col(name).alias(f"__{name}") for name in identity], "__first"))
    later = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in identity]) \
        & (F.col("__order") > F.col("__first"))
    return ordered.join(copies, later, "left_anti").drop("__order")


def duplicates_dropped(events: DataFrame, keys: list[str] = WRITER_KEY) -> DataFrame:
    """Rows that ``first_arrivals`` leaves out, per key."""
    copies = events.groupBy(*keys, "exchange_sequence_id").agg(F.count("*").alias("n"))
    return copies.groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("dropped"))


# --- silence ----------------------------------------------------------------------------------

def with_timeout(events: DataFrame, config: DataFrame, default_seconds: int) -> DataFrame:
    """Add ``timeout_s``: the override of the row's market, else the global value.

    The configuration has one row per stream. Spark broadcasts it only if its size
    at run time allows; otherwise the join shuffles, and adaptive execution splits hot keys.
    """
    overrides = config.select(*STREAM_KEY, "data_timeout_secs")
    joined = events.join(overrides, STREAM_KEY, "left")
    return joined.withColumn("timeout_s", F.coalesce("data_timeout_secs", F.lit(default_seconds).cast("bigint"))) \
        .drop("data_timeout_secs")


def stale_periods(events: DataFrame, tiebreak: str, keys: list[str] = STREAM_KEY, hot_rows: int | None = None) -> DataFrame:
    """Silences longer than ``timeout_s``, at the row that ended them.

    Longer than the timeout is a warning, longer than three times the timeout a reconnect.
    """
    marked = with_previous(
        events.select(*keys, "timestamp_collector", tiebreak, "timeout_s"), keys, ["timestamp_collector", tiebreak],
        {"previous_us": Previous("last", "timestamp_collector")}, hot_rows)
    silence = F.col("timestamp_collector") - F.col("previous_us")
    limit = F.col("timeout_s") * SECOND
    return marked.where(silence > limit).select(
        *keys, tiebreak, "previous_us", F.col("timestamp_collector").alias("resumed_us"), silence.alias("silence_us"),
        F.when(silence > limit * 3, "reconnect").otherwise("warn").alias("action"))


def silent_subscriptions(subscriptions: DataFrame, events: DataFrame, until_us: int, hot_rows: int | None = None) -> DataFrame:
    """Subscriptions by how long they waited for their first row.

    ``subscriptions`` has (stream key, subscribed_us, timeout_s). No data within the
    grace period is a warning, within three timeouts a reconnect. A stream that never
    sent data is judged at ``until_us``. Subscriptions and rows are merged in descending
    time, where the row before a subscription is the first one after it; a join would
    pair every row with every subscription of its stream.
    """
    asked = subscriptions.select(
        *STREAM_KEY, (-F.col("subscribed_us")).alias("__back_us"), F.lit(1).alias("__rank"), F.lit(None).cast("bigint").alias("__row_us"),
        "subscribed_us", F.col("timeout_s").cast("bigint").alias("timeout_s"))
    rows = events.select(
        *STREAM_KEY, (-F.col("timestamp_collector")).alias("__back_us"), F.lit(0).alias("__rank"),
        F.col("timestamp_collector").alias("__row_us"), F.lit(None).cast("bigint").alias("subscribed_us"),
        F.lit(None).cast("bigint").alias("timeout_s"))
    merged = with_previous(
        rows.unionByName(asked), STREAM_KEY, ["__back_us", "__rank"], {"first_us": Previous("last", "__row_us")}, hot_rows)
    waited = F.coalesce("first_us", F.lit(until_us).cast("bigint")) - F.col("subscribed_us")
    return merged.where(F.col("subscribed_us").isNotNull()).select(
        *STREAM_KEY, "subscribed_us", "first_us", waited.alias("waited_us"),
        F.when(waited > F.col("timeout_s") * 3 * SECOND, "reconnect")
        .when(waited > SUBSCRIPTION_GRACE_SECONDS * SECOND, "warn").otherwise("ok").alias("action"))


def message_timeouts(events: DataFrame, streams: DataFrame, since_us: int, until_us: int, keys: list[str] = STREAM_KEY,
                     hot_rows: int | None = None) -> DataFrame:
    """Every reconnect for want of data: one row per stream and three timeouts without any.

    ``streams`` has the configured streams with ``timeout_s``, each subscribed at ``since_us``; rows of other streams do
    not count. A silence runs from the subscription or a row to the next row, or to ``until_us`` where none
    comes. After a reconnect the stream is subscribed anew, and three more timeouts of silence are the next one. Column
    ``cause`` tells whether the silence began with data (``stalled``) or with the subscription (``never_received``).
    """
    time = F.col("timestamp_collector")
    rows = events.where((time >= since_us) & (time < until_us)).select(*keys, time.alias("__us"), F.lit(1).alias("__rank"))
    ends = F.explode(F.array(*[F.struct(F.lit(us).cast("bigint").alias("us"), F.lit(rank).alias("rank")) for us, rank in ((since_us, 0), (until_us, 2))]))
    marks = streams.select(*keys, ends.alias("__end")).select(*keys, F.col("__end.us").alias("__us"), F.col("__end.rank").alias("__rank"))
    linked = with_previous(rows.unionByName(marks), keys, ["__us", "__rank"], {
        "__since": Previous("last", "__us"), "__was": Previous("last", "__rank")}, hot_rows)
    limit = F.col("timeout_s") * (3 * SECOND)
    silent = linked.where("__since IS NOT NULL").join(streams.select(*keys, F.col("timeout_s").cast("bigint").alias("timeout_s")), keys)
    silent = silent.where(F.col("__us") - F.col("__since") > limit)
    return silent.select(
        *keys, F.when(F.col("__was") == 0, "never_received").otherwise("stalled").alias("cause"), F.col("__since").alias("silent_since_us"),
        F.explode(F.sequence(F.col("__since") + limit, F.col("__us") - 1, limit)).alias("at_us"))


def dead_after_us(exchange: Column | str = "exchange") -> Column:
    """Silence over all frames after which a connection of the venue counts as dead."""
    exchange = F.col(exchange) if isinstance(exchange, str) else exchange
    limit = F.lit(DEAD_CONNECTION_SECONDS)
    for name, one in VENUES.items():
        if one.ping_seconds:
            limit = F.when(exchange == name, F.lit(max(DEAD_CONNECTION_SECONDS, 2 * one.ping_seconds))).otherwise(limit)
    return limit.cast("bigint") * SECOND


def session_rows(frames: DataFrame, tiebreak: str, keys: list[str] = STREAM_KEY, hot_rows: int | None = None) -> DataFrame:
    """Number the connection sessions: a new one starts after the venue's dead time without any frame."""
    order = ["timestamp_collector", tiebreak]
    sizes = key_sizes(frames, keys)
    marked = with_previous(frames, keys, order, {"__previous_us": Previous("last", "timestamp_collector")}, hot_rows, sizes)
    silence = F.col("timestamp_collector") - F.col("__previous_us")
    starts = F.coalesce(silence > dead_after_us(), F.lit(True)).cast("bigint")
    flagged = marked.withColumn("starts_session", starts).drop("__previous_us")
    return with_previous(flagged, keys, order, {"session": Previous("sum", "starts_session")}, hot_rows, sizes)


def sessions(frames: DataFrame, tiebreak: str, keys: list[str] = STREAM_KEY, hot_rows: int | None = None) -> DataFrame:
    """One row per connection session."""
    narrow = frames.select(*keys, "timestamp_collector", tiebreak)
    return session_rows(narrow, tiebreak, keys, hot_rows).groupBy(*keys, "session").agg(
        F.min("timestamp_collector").alias("opened_us"), F.max("timestamp_collector").alias("closed_us"),
        F.count("*").alias("frames"))


def disconnect_diagnostics(parsed: DataFrame, tiebreak: str, keys: list[str] = STREAM_KEY, hot_rows: int | None = None) -> DataFrame:
    """At each session start but the first: whole seconds since data, since a pong and since any frame.

    NULL means never received, which is not the same as just received.
    """
    receipt = F.col("timestamp_collector")
    # Stored, because the sizes of the keys are counted first and the frames would be parsed for that as well.
    narrow = stored(parsed.select(
        *keys, "timestamp_collector", tiebreak,
        F.when(F.col("kind").isin("orderbook", "trade"), receipt).alias("__data_us"),
        F.when(F.col("kind") == "pong", receipt).alias("__pong_us")), "diagnostics")
    marked = with_previous(narrow, keys, ["timestamp_collector", tiebreak], {
        "__any": Previous("last", "timestamp_collector"),
        "__data": Previous("last", "__data_us"),
        "__pong": Previous("last", "__pong_us"),
    }, hot_rows)
    return marked.where(receipt - F.col("__any") > dead_after_us()).select(
        *keys, "timestamp_collector", tiebreak,
        *[whole(receipt - F.col(f"__{name}"), SECOND).alias(f"secs_since_{label}")
          for name, label in (("data", "data"), ("pong", "pong"), ("any", "any_frame"))])


# --- parse errors -----------------------------------------------------------------------------

def parse_error_windows(
    parsed: DataFrame,
    window_seconds: int = BREAKER_WINDOW_SECONDS,
    ratio: float = BREAKER_RATIO,
    min_samples: int = BREAKER_MIN_SAMPLES,
    keys: list[str] = STREAM_KEY,
) -> DataFrame:
    """Error share per key and clock-aligned window, and whether the breaker trips.

    Only data rows and errors count; replies and pongs do not. Windows follow the clock,
    so that they can be aggregated in parallel, and do not start at the first frame.
    """
    width = window_seconds * SECOND
    window = (whole("timestamp_collector", width) * width).alias("window_us")
    counted = parsed.where(F.col("kind").isin("orderbook", "trade", "error"))
    totals = counted.groupBy(*keys, window).agg(
        F.count_if(F.col("kind") == "error").alias("errors"), F.count("*").alias("samples"))
    share = F.col("errors") / F.col("samples")
    return totals.select(
        "*", share.alias("error_ratio"),
        ((F.col("samples") >= min_samples) & (share >= ratio) & (F.col("errors") > 0)).alias("tripped"))


def breaker_checks(
    parsed: DataFrame, tiebreak: str, window_seconds: int = BREAKER_WINDOW_SECONDS, ratio: float = BREAKER_RATIO,
    min_samples: int = BREAKER_MIN_SAMPLES, keys: list[str] = STREAM_KEY, hot_rows: int | None = None,
) -> DataFrame:
    """The breaker as it runs live: a window opens with the first row after the one before is over, and is tested at every error.

    One row per error, with the errors and samples of its window up to and including it. Openings
    are found as those of files are, and reach their rows as rows of their own, in order. The narrow rows,
    the openings and the rows with their windows are stored, so frames are parsed once and windows found once.
    """
    counted = stored(parsed.where(F.col("kind").isin("orderbook", "trade", "error")).select(
        *keys, "timestamp_collector", tiebreak, (F.col("kind") == "error").cast("bigint").alias("__error")), "breaker-rows").select(
        "*", F.lit(1).cast("bigint").alias("__one"), F.lit(1).alias("__rank"), F.lit(None).cast("bigint").alias("__opened"))
    openings = stored(rotation_files(counted, keys, window_seconds * SECOND, slice_rows=hot_rows or SLICE_ROWS).select(
        *keys, F.col("opened_us").alias("timestamp_collector"), F.lit(None).cast(counted.schema[tiebreak].dataType).alias(tiebreak),
        F.lit(None).cast("bigint").alias("__error"), F.lit(None).cast("bigint").alias("__one"), F.lit(0).alias("__rank"),
        F.col("opened_us").alias("__opened")), "breaker-openings")
    windowed = stored(with_previous(
        counted.unionByName(openings), keys, ["timestamp_collector", "__rank", tiebreak], {"opened_us": Previous("last", "__opened")},
        hot_rows).where("__rank = 1"), "breaker-windows")
    summed = with_previous(
        windowed, [*keys, "opened_us"], ["timestamp_collector", tiebreak],
        {"errors": Previous("sum", "__error"), "samples": Previous("sum", "__one")}, hot_rows)
    share = F.col("errors") / F.col("samples")
    return summed.where("__error = 1").select(
        *keys, tiebreak, "timestamp_collector", "opened_us", "errors", "samples", share.alias("error_ratio"),
        ((F.col("samples") >= min_samples) & (share >= ratio)).alias("tripped"))


def breaker_trips(checks: DataFrame, keys: list[str] = STREAM_KEY) -> DataFrame:
    """Windows in which the breaker opened its circuit, and the error at which it did: the first that tripped it."""
    return checks.where("tripped").groupBy(*keys, "opened_us").agg(F.min("timestamp_collector").alias("tripped_us"))
