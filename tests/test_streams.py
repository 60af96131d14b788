"""Streams against their batch forms, over restarts."""

import pytest
from pyspark.sql import functions as F

from tickharbor.operators import quality as Q
from tickharbor.operators.parsing import market_events, parse_frames
from tickharbor.sources.archive import read_archive
from tickharbor.sources.frames import read_frames
from tickharbor.sources.sample_market import landed_frames, market_base
from tickharbor.streaming import ingest, progress, state

SMALL = "/root/testdata/sf0.001"


def land(df, path, low, high):
    df.where(f"event_id >= {low} AND event_id < {high}").coalesce(1).write.mode("append").parquet(str(path))


def finish(rows, path, checkpoint):
    query = rows.writeStream.format("parquet").option("path", str(path)).option("checkpointLocation", str(checkpoint)) \
        .trigger(availableNow=True).start()
    query.awaitTermination()


def test_every_row_is_answered_over_restarts_and_late_rows(spark, tmp_path):
    base = market_base(spark, SMALL)
    # The middle rows arrive last, long after later ones.
    for low, high in ((0, 300), (600, 1000), (300, 600)):
        land(base, tmp_path / "in", low, high)
        source = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ingest.drain([state.sequence_stream(source, "event_id", str(tmp_path / "out"), str(tmp_path / "cp"))])
    got = state.checked_rows(spark, str(tmp_path / "out"), "event_id").select("event_id", "result", "gap_size").collect()
    # As if the files had been received one after another.
    turn = F.when(F.col("event_id") < 300, 0).when(F.col("event_id") >= 600, 1).otherwise(2)
    files = base.withColumn("timestamp_collector", F.col("timestamp_collector") + turn * 10**15)
    assert sorted(got) == sorted(Q.sequence_check(files, "event_id").select("event_id", "result", "gap_size").collect())
    assert sorted(p.name for p in (tmp_path / "out" / "marks").iterdir()) == ["batch=1", "batch=2"]


def test_counters_over_more_batches_than_a_query_remembers(spark, tmp_path):
    base = market_base(spark, SMALL).select("event_id", "timestamp_collector")
    base.repartition(105).write.parquet(str(tmp_path / "in"))
    files = [f for f in (tmp_path / "in").iterdir() if f.suffix == ".parquet"]
    source = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ingest.drain([progress.counter_stream(source, "all", str(tmp_path / "n"), str(tmp_path / "cp"))])
    assert len(files) > 100 and len(list((tmp_path / "n").iterdir())) == len(files)
    expected = base.agg(F.count("*"), F.max("timestamp_collector")).first()
    assert progress.counted(spark, str(tmp_path / "n")).collect() == [("all", *expected)]


def test_an_unfinished_stream_is_no_result(spark, tmp_path):
    base = market_base(spark, SMALL).select("event_id", "timestamp_collector")
    base.repartition(40).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = progress.counter_stream(source, "all", str(tmp_path / "n"), str(tmp_path / "cp"))
    with pytest.raises(ingest.Unfinished):
        ingest.drain([query], 1)


def test_late_rows_are_counted(spark, tmp_path):
    listener = progress.CounterListener()
    spark.streams.addListener(listener)
    base = market_base(spark, SMALL)
    for k, (low, high) in enumerate(((500, 1000), (0, 500))):
        land(base, tmp_path / "in", low, high)
        source = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        finish(state.drop_duplicates(source, "1 minute"), tmp_path / "out", tmp_path / "cp")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    assert sum(listener.late.values()) > 0


def test_dedup_over_a_restart(spark, tmp_path):
    base = market_base(spark, SMALL)
    for low, high in ((0, 500), (300, 1000)):
        land(base, tmp_path / "in", low, high)
        source = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
        finish(state.drop_duplicates(source, "100 days"), tmp_path / "out", tmp_path / "cp")
    keys = ["exchange", "symbol", "data_type", "exchange_sequence_id"]
    got = spark.read.parquet(str(tmp_path / "out")).select(*keys)
    assert sorted(got.collect()) == sorted(base.select(*keys).distinct().collect())


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("landed") / "frames"
    frames = landed_frames(spark, SMALL)
    frames.where("event_id < 60").write.parquet(str(path))
    return str(path), market_events(parse_frames(frames.where("event_id < 60")))


def test_archive_stream_counts_as_it_goes(spark, landed, tmp_path):
    path, expected = landed
    listener = progress.CounterListener()
    spark.streams.addListener(listener)
    query = ingest.archive_stream(read_frames(spark, path, stream=True, form="parquet"), str(tmp_path / "a"), str(tmp_path / "cp"))
    ingest.drain([query], 120)
    assert read_archive(spark, str(tmp_path / "a")).count() == expected.count()
    assert progress.lag(query)[0]["source"].startswith("FileStreamSource")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    assert listener.rows["archived"] == expected.count()
    again = ingest.archive_stream(read_frames(spark, path, stream=True, form="parquet"), str(tmp_path / "a"), str(tmp_path / "cp"))
    ingest.drain([again], 120)
    assert read_archive(spark, str(tmp_path / "a")).count() == expected.count()


def test_fan_out_repeats_a_batch_without_doubling(spark, landed, tmp_path):
    path, expected = landed
    for attempt in range(2):  # a new checkpoint makes batch 0 run again
        frames = read_frames(spark, path, stream=True, form="parquet")
        ingest.drain([ingest.fan_out_stream(frames, "both", str(tmp_path / "r"), str(tmp_path / "l"), str(tmp_path / f"cp{attempt}"))], 120)
    for root in ("r", "l"):
        assert spark.read.parquet(str(tmp_path / root)).count() == expected.count()


def test_micro_batches_are_read_by_all_cores(spark, tmp_path):
    """Four batches, each in as many files as there are cores, and every row in one of them."""
    from tickharbor.plans import streams

    cores, batches = spark.sparkContext.defaultParallelism, []

    def note(batch, number):
        batches.append((batch.count(), batch.select(F.input_file_name().alias("file")).distinct().count()))

    ingest.drain([streams._in_batches(spark, SMALL).writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "cp"))
                  .trigger(availableNow=True).start()], 120)
    assert [files for _, files in batches] == [cores] * 4
    assert sum(rows for rows, _ in batches) == landed_frames(spark, SMALL).count()
