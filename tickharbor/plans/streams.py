"""Streams over the landed tables, run until everything that has landed is processed.

The sink is a table in the shared folder; the query then reads that table. The driver
holds no rows.
"""

from pyspark.sql import functions as F

from tickharbor.operators.parsing import market_events, parse_frames
from tickharbor.plans import payloads  # noqa: F401  its SQL is used here
from tickharbor.plans.catalog import CATALOG, add
from tickharbor.plans.frames import DUCK_EXPECTED
from tickharbor.plans.quality import DUCK_CHECKED
from tickharbor.schemas import WRITER_KEY
from tickharbor.session import configure, stored, work_folder
from tickharbor.sources import archive as A
from tickharbor.sources import committed as K
from tickharbor.sources.frames import read_frames
from tickharbor.sources.sample_market import DUCK_MARKET, landed_frames, market_base
from tickharbor.streaming import corrections, ingest, progress, state

_STREAM = "exchange, symbol, feed"
# Micro-batches that are taken in one after another where a query shows several.
_BATCHES = 4


def _landed(spark, d, table=landed_frames, files=1):
    """Write a derived table once, as files that a stream can pick up."""
    path = work_folder(spark, "landed")
    rows = table(spark, d)
    (rows.repartitionByRange(files, "timestamp_collector") if files > 1 else rows).write.parquet(path)
    return path, rows.schema


def _stream_of(spark, d, table=landed_frames, files=1, batch=None):
    """The landed table as a stream, ``batch`` files in each micro-batch."""
    path, schema = _landed(spark, d, table, files)
    reader = configure(spark).readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", batch) if batch else reader).parquet(path)


def _in_batches(spark, d):
    """The landed frames as a stream of ``_BATCHES`` stretches of time, each in as many files as there are cores to read them."""
    cores = spark.sparkContext.defaultParallelism
    return _stream_of(spark, d, files=_BATCHES * cores, batch=cores)


def _to_table(rows):
    spark = rows.sparkSession
    path = work_folder(spark, "stream-table")
    query = rows.writeStream.format("parquet").option("path", path).outputMode("append") \
        .option("checkpointLocation", work_folder(spark, "stream-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def _stream_archive(spark, d):
    path, _ = _landed(spark, d, files=spark.sparkContext.defaultParallelism)
    root = work_folder(spark, "stream-archive")
    frames = read_frames(spark, path, stream=True, form="parquet")
    ingest.drain([ingest.archive_stream(frames, root, work_folder(spark, "checkpoint"), server="srv1")])
    return A.read_archive(spark, root).groupBy("exchange", "symbol", "data_type").agg(
        F.count("*").alias("rows"), F.min("timestamp_collector").alias("first_us"))


add("stream_archive", _stream_archive, "STR-1, STR-2, STR-7, SRC-1, SNK-1", f"""WITH {DUCK_EXPECTED} SELECT exchange, symbol, kind AS data_type,
  count(*) AS rows, min(timestamp_collector) AS first_us FROM expected WHERE kind IN ('orderbook', 'trade') GROUP BY ALL""")


def _stream_committed(spark, d):
    """Four micro-batches; dates that several of them touch are joined in between."""
    root = work_folder(spark, "committed")
    frames = _in_batches(spark, d)
    ingest.drain([K.committed_stream(frames, root, work_folder(spark, "checkpoint"), server="srv1", most_parts=1)])
    parts = spark.createDataFrame(list(K.current_version(spark, root).folders), "part string, date string, n bigint") \
        .groupBy("date").agg(F.countDistinct("part").alias("parts"))
    return K.read_committed(spark, root).groupBy(*WRITER_KEY, "date").agg(
        F.count("*").alias("rows"), F.min("timestamp_collector").alias("first_us")).join(parts, "date")


add("stream_committed", _stream_committed, "STR-1, SNK-6, STR-2", f"""WITH {DUCK_EXPECTED} SELECT exchange, symbol, kind AS data_type,
  strftime(make_timestamp(timestamp_collector), '%Y-%m-%d') AS date, count(*) AS rows, min(timestamp_collector) AS first_us, CAST(1 AS BIGINT) AS parts
FROM expected WHERE kind IN ('orderbook', 'trade') GROUP BY ALL""")


def _stream_per_feed(spark, d):
    path, _ = _landed(spark, d, files=spark.sparkContext.defaultParallelism)
    root = work_folder(spark, "feeds")
    started = ingest.streams_per_feed(read_frames(spark, path, stream=True, form="parquet"), root, work_folder(spark, "checkpoints"))
    ingest.drain(list(started.values()))
    counted = [A.read_archive(spark, f"{root}/{feed}").groupBy("exchange", "data_type").agg(F.count("*").alias("rows"))
               .withColumn("feed", F.lit(feed)) for feed in started]
    return counted[0].unionByName(counted[1])


add("stream_per_feed", _stream_per_feed, "STR-8", f"""WITH {DUCK_EXPECTED} SELECT exchange, kind AS data_type, count(*) AS rows, feed
FROM expected WHERE kind IN ('orderbook', 'trade') GROUP BY ALL""")


def _stream_dead_letters(spark, d):
    path, _ = _landed(spark, d)
    target = work_folder(spark, "dead-letters")
    ingest.drain([ingest.dead_letter_stream(read_frames(spark, path, stream=True, form="parquet"), target, work_folder(spark, "checkpoint"))])
    return spark.read.schema("exchange string, native_symbol string, feed string, timestamp_collector bigint, frame string, error string").json(target)


add("stream_dead_letters", _stream_dead_letters, "SNK-5, STR-1", f"""WITH {DUCK_EXPECTED}
SELECT exchange, native_symbol, feed, timestamp_collector, frame, error FROM expected WHERE kind = 'error'""")


def _stream_fan_out(spark, d):
    path, _ = _landed(spark, d)
    remote, local = work_folder(spark, "remote"), work_folder(spark, "local")
    frames = read_frames(spark, path, stream=True, form="parquet")
    ingest.drain([ingest.fan_out_stream(frames, "both", remote, local, work_folder(spark, "checkpoint"))])
    counted = [spark.read.parquet(root).groupBy("data_type").agg(F.count("*").alias("rows")).withColumn("root", F.lit(name))
               for name, root in (("remote", remote), ("local", local))]
    return counted[0].unionByName(counted[1])


add("stream_fan_out", _stream_fan_out, "SNK-4, STR-1", f"""WITH {DUCK_EXPECTED} SELECT kind AS data_type, count(*) AS rows, root FROM expected
CROSS JOIN (VALUES ('remote'), ('local')) AS roots(root) WHERE kind IN ('orderbook', 'trade') GROUP BY ALL""")



def _stream_counters(spark, d):
    """Counters of all micro-batches, summed up from their table."""
    path = work_folder(spark, "counters")
    rows = market_events(parse_frames(_in_batches(spark, d)))
    ingest.drain([progress.counter_stream(rows, "archived", path, work_folder(spark, "checkpoint"))])
    return progress.counted(spark, path)


add("stream_counters", _stream_counters, "STR-9, STR-1", f"""WITH {DUCK_EXPECTED}
SELECT 'archived' AS name, count(*) AS rows, max(timestamp_collector) AS last_us FROM expected WHERE kind IN ('orderbook', 'trade')""")

def _stream_sequence_check(spark, d):
    """Rows land in stretches of time, and the stream goes on after each: the batch form says the same."""
    rows = stored(market_base(spark, d), "market")
    low, high = rows.agg(F.min("timestamp_collector"), F.max("timestamp_collector")).first()
    width = (high - low) // _BATCHES + 1 if low is not None else 1
    landed, path, checkpoint = (work_folder(spark, name) for name in ("landed", "sequence", "checkpoint"))
    for stretch in range(_BATCHES):
        rows.where(F.floor((F.col("timestamp_collector") - (low or 0)) / width) == stretch).write.mode("append").parquet(landed)
        source = configure(spark).readStream.schema(rows.schema).parquet(landed)
        ingest.drain([state.sequence_stream(source, "event_id", path, checkpoint)])
    return state.checked_rows(spark, path, "event_id")


add("stream_sequence_check", _stream_sequence_check, "STR-4",
    f"""WITH {DUCK_CHECKED} SELECT exchange, symbol, data_type, timestamp_collector, event_id, sequence, result, gap_size FROM checked""")


def _stream_dedup(spark, d):
    kept = state.drop_duplicates(_stream_of(spark, d, market_base), watermark="40 days")
    return _to_table(kept).select("exchange", "symbol", "data_type", "exchange_sequence_id")


add("stream_dedup", _stream_dedup, "STR-5, WIN-2",
    f"WITH {DUCK_MARKET} SELECT DISTINCT exchange, symbol, data_type, exchange_sequence_id FROM priced")

# Later than the latest receipt by more than any window, gap or watermark here.
_CLOSE_SECONDS = 3 * 86_400


def _closed(spark, d, table, stream):
    """Run a stream over the landed table, land its closing row, and run on: nothing is left open."""
    path, schema = _landed(spark, d, table)
    target, checkpoint = work_folder(spark, "stream-table"), work_folder(spark, "checkpoint")
    landed = spark.read.schema(schema).parquet(path)
    for last in (False, True):
        if last:
            stored(state.closing_row(landed, _CLOSE_SECONDS), "closing-row").write.mode("append").parquet(path)
        rows = stream(configure(spark).readStream.schema(schema).parquet(path))
        ingest.drain([rows.writeStream.format("parquet").option("path", target).outputMode("append")
                      .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()])
    return spark.read.schema(rows.schema).parquet(target)


def _error_windows(frames):
    return state.parse_error_stream(parse_frames(frames), window_seconds=86_400, ratio=0.1, min_samples=5)


add("stream_error_windows", lambda spark, d: _closed(spark, d, landed_frames, _error_windows), "STR-3, AGG-5",
    f"""WITH {DUCK_EXPECTED}, counted AS (SELECT * FROM expected WHERE kind IN ('orderbook', 'trade', 'error')),
w AS (SELECT {_STREAM}, timestamp_collector // 86400000000 * 86400000000 AS window_us, count(*) FILTER (kind = 'error') AS errors, count(*) AS samples
  FROM counted GROUP BY ALL)
SELECT *, errors / samples AS error_ratio, samples >= 5 AND errors / samples >= 0.1 AND errors > 0 AS tripped FROM w""")

add("stream_sessions", lambda spark, d: _closed(spark, d, market_base, state.session_stream), "STR-6, WIN-5",
    f"""WITH {DUCK_MARKET},
linked AS (SELECT {_STREAM}, timestamp_collector, lag(timestamp_collector) OVER (PARTITION BY {_STREAM} ORDER BY timestamp_collector) AS previous_us FROM priced),
numbered AS (SELECT *, sum(CASE WHEN timestamp_collector - previous_us <= 90000000 THEN 0 ELSE 1 END)
  OVER (PARTITION BY {_STREAM} ORDER BY timestamp_collector ROWS UNBOUNDED PRECEDING) AS session FROM linked)
SELECT {_STREAM}, min(timestamp_collector) AS opened_us, max(timestamp_collector) AS closed_us, count(*) AS frames
FROM numbered GROUP BY {_STREAM}, session""")


def _mixed(spark, d, table):
    """The table as a stream of several micro-batches; each covers all of its time, so from the second on rows come late."""
    rows, path = table(spark, d), work_folder(spark, "landed-mixed")
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), _BATCHES)
    rows.repartition(files, F.crc32(F.col("event_id").cast("string"))).write.parquet(path)
    return configure(spark).readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // _BATCHES)).parquet(path)


def _late_first_arrivals(spark, d):
    source, path = _mixed(spark, d, market_base), work_folder(spark, "first-arrivals")
    ingest.drain([corrections.first_arrival_stream(source, "event_id", path, work_folder(spark, "checkpoint"))])
    kept = corrections.first_arrival_rows(spark, path, corrections.schema_text(source), "event_id")
    return kept.select("exchange", "symbol", "data_type", "exchange_sequence_id", "event_id", "timestamp_collector")


add("stream_late_first_arrivals", _late_first_arrivals, "STR-5, WIN-2", f"""WITH {DUCK_MARKET}
SELECT exchange, symbol, data_type, exchange_sequence_id, event_id, timestamp_collector FROM priced
QUALIFY row_number() OVER (PARTITION BY exchange, symbol, data_type, exchange_sequence_id ORDER BY timestamp_collector, event_id) = 1""")


def _late_error_windows(spark, d):
    path = work_folder(spark, "error-counts")
    parsed = parse_frames(_mixed(spark, d, landed_frames))
    ingest.drain([corrections.error_count_stream(parsed, path, work_folder(spark, "checkpoint"), window_seconds=86_400)])
    return corrections.error_windows(spark, path, ratio=0.1, min_samples=5)


add("stream_late_error_windows", _late_error_windows, "STR-3, AGG-5", CATALOG["stream_error_windows"].sql)


def _late_sessions(spark, d):
    path = work_folder(spark, "session-parts")
    ingest.drain([corrections.session_part_stream(_mixed(spark, d, market_base), "event_id", path, work_folder(spark, "checkpoint"))])
    return corrections.joined_sessions(spark, path)


add("stream_late_sessions", _late_sessions, "STR-6, WIN-5", CATALOG["stream_sessions"].sql)


def _stream_book(spark, d):
    """Frames as the venues' payloads carry them, in batches that each cover all of the time."""
    path = work_folder(spark, "book")
    events = market_events(parse_frames(_mixed(spark, d, landed_frames)), "event_id")
    ingest.drain([corrections.book_stream(events, "event_id", path, work_folder(spark, "checkpoint"))])
    return corrections.latest_book(spark, path, "event_id")


add("stream_book", _stream_book, "PAY-7, STR-1", CATALOG["current_book"].sql)
