"""Writing, reading, listing and compacting the archive."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from tickharbor.operators.joins import health, verify_copies
from tickharbor.sources import archive as A
from tickharbor.sources import config as C
from tickharbor.sources import plain_archive as P

DAY = 86_400_000_000
SCHEMA = "exchange string, symbol string, data_type string, exchange_sequence_id string, timestamp_collector long, timestamp_exchange long, data string"


@pytest.fixture(scope="module")
def events(spark):
    rows = [("okx", "btc" if i % 3 else "eth", "trade" if i % 2 else "orderbook", str(i), 19_000 * DAY + i * DAY // 50, 5, "{}") for i in range(200)]
    return spark.createDataFrame(rows, SCHEMA)


def test_round_trip_manifest_and_pruning(spark, events, tmp_path):
    root = str(tmp_path / "a")
    A.write_archive(events, root, server="srv", tasks=3)
    back = A.read_archive(spark, root)
    assert sorted(back.select(*events.columns).collect()) == sorted(events.collect())
    manifest = A.file_manifest(spark, root).collect()
    assert sum(row.rows for row in manifest) == 200
    assert all(row.size == os.path.getsize(re.sub("^file:/+", "/", row.path)) for row in manifest)
    plan = back.where("symbol = 'btc' AND date = '2022-01-08'").select("data")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "ReadSchema: struct<data:string>" in plan


def test_arrival_order_within_files(spark, events, tmp_path):
    root = str(tmp_path / "b")
    A.write_archive(events.orderBy(F.rand(1)), root, tasks=1)
    for row in A.file_manifest(spark, root).collect():
        times = [r[0] for r in spark.read.parquet(row.path).select("timestamp_collector").collect()]
        assert times == sorted(times)


def test_compaction_leaves_one_file_per_key_and_day(spark, events, tmp_path):
    root, target = str(tmp_path / "c"), str(tmp_path / "d")
    for part in range(3):
        A.write_archive(events.where(F.col("timestamp_collector") % 3 == part), root)
    dates = [row[0] for row in A.read_archive(spark, root).select("date").distinct().collect()]
    A.compact(spark, root, target, dates[:2])
    A.compact(spark, root, target, dates[1:])
    rows = A.read_archive(spark, target)
    assert rows.count() == 200
    assert A.file_manifest(spark, target).count() == rows.select(*A.PARTITIONS).distinct().count()
    A.compact(spark, root, str(tmp_path / "e"), dates, max_records=5)
    assert A.read_archive(spark, str(tmp_path / "e")).count() == 200


def test_a_plain_tree_is_read_with_its_path_values(spark, events, tmp_path):
    files = {"okx/btc/trade/2022-01-08/1641600000000.parquet": 3, "okx/btc/orderbook/srv/2022-01-09/1641700000000.parquet": 4}
    one = events.select("exchange", "symbol", "exchange_sequence_id", "timestamp_collector", "timestamp_exchange", "data")
    for path, n in files.items():
        one.limit(n).coalesce(1).write.parquet(str(tmp_path / "raw" / str(n)))
        part = next((tmp_path / "raw" / str(n)).glob("part-*.parquet"))
        (tmp_path / "plain" / path).parent.mkdir(parents=True)
        shutil.copy(part, tmp_path / "plain" / path)
    df = P.read_plain_archive(spark, str(tmp_path / "plain"))
    counted = df.groupBy("data_type", "server", "file_date", "file_ts").count().collect()
    assert {tuple(row) for row in counted} == {("trade", None, "2022-01-08", 1641600000000, 3), ("orderbook", "srv", "2022-01-09", 1641700000000, 4)}
    assert P.read_plain_archive(spark, str(tmp_path / "plain"), ["okx/btc/trade"]).count() == 3


def test_a_plain_tree_is_written_by_openings_and_listed_by_filters(spark, events, tmp_path):
    root, age = str(tmp_path / "written"), DAY // 10
    manifest = {row.relative_path: row for row in P.write_plain_archive(events, root, "srv", age_us=age).collect()}
    found = {str(path.relative_to(root)): path for path in (tmp_path / "written").rglob("*.parquet")}
    assert set(found) == set(manifest)
    assert all(row.size == os.path.getsize(found[name]) for name, row in manifest.items())
    back = P.read_plain_archive(spark, root)
    assert sorted(back.select(*events.columns).collect()) == sorted(events.collect())
    spans = back.groupBy("file_path", "file_ts").agg(F.min("timestamp_collector").alias("a"), F.max("timestamp_collector").alias("z")).collect()
    assert all(row.file_ts == row.a // 1000 and row.z - row.a <= age for row in spans)
    one = P.read_plain_archive(spark, root, venues=["okx"], symbols=["eth"], data_types=["trade"], dates=["2022-01-08", "2022-01-09"])
    wanted = {name for name in found if re.match(r"okx/eth/trade/srv/2022-01-0[89]/", name)}
    assert 0 < len(one.inputFiles()) == len(wanted) < len(found)
    assert one.count() == sum(manifest[name].rows for name in wanted)
    assert len(P.read_plain_archive(spark, root, dates=["2022-01-08"]).inputFiles()) == sum("/2022-01-08/" in name for name in found)
    assert P.read_plain_archive(spark, root, venues=["upbit"]).count() == P.read_plain_archive(spark, root, symbols=[]).count() == 0
    with pytest.raises(ValueError):
        P.read_plain_archive(spark, root, symbols=["../x"])


def test_plain_files_of_null_keys_no_events_and_files_closed_by_size(spark, events, tmp_path):
    assert P.write_plain_archive(events.limit(0), str(tmp_path / "none")).count() == 0
    nameless = events.limit(3).withColumn("symbol", F.lit(None).cast("string"))
    (row,) = P.write_plain_archive(nameless.where("data_type = 'trade'"), str(tmp_path / "null")).collect()
    assert row.relative_path.startswith("okx/unknown/trade/20") and row.symbol is None
    # Rows of one time at a boundary of size: all are kept, in the file that opens there.
    tied = events.withColumn("timestamp_collector", F.col("timestamp_collector") - F.col("timestamp_collector") % (DAY // 10)).withColumn("symbol", F.lit("btc"))
    rules = {"size": F.length("data").cast("bigint"), "max_bytes": 10, "look_rows": 3, "tiebreak": "exchange_sequence_id", "age_us": DAY}
    manifest = P.write_plain_archive(tied, str(tmp_path / "tied"), **rules)
    assert manifest.agg(F.sum("rows")).first()[0] == 200 and manifest.count() > 10
    assert P.read_plain_archive(spark, str(tmp_path / "tied")).count() == 200


def test_plain_archive_computes_its_events_once(spark, events, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    manifest = P.write_plain_archive(events.mapInArrow(count, events.schema), str(tmp_path / "once"), age_us=DAY)
    assert manifest.agg(F.sum("rows")).first()[0] == seen.value == 200


def test_copies(spark):
    local = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "relative_path string, size long")
    remote = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "relative_path string, size long")
    assert {r.relative_path: r.status for r in verify_copies(local, remote).collect()} == {
        "a": "ok", "b": "size_mismatch", "c": "missing", "d": "unexpected"}


@pytest.mark.parametrize(("ups", "dropped", "status", "reason"), [
    ([], 0, "starting", None), ([False, False], 3, "unhealthy", None), ([True, False], 3, "degraded", "partial_connections"),
    ([True], 3, "degraded", "backpressure"), ([True, True], 0, "healthy", None)])
def test_health(spark, ups, dropped, status, reason):
    row = health(spark.createDataFrame([(up,) for up in ups], "up boolean"), dropped).first()
    assert (row.status, row.degraded_reason) == (status, reason)


def test_config(spark):
    text = """
    [[markets]]
    exchange = "OKX"
    symbols = ["BTC-USDT", "ETH-USDT"]
    feeds = ["trade", "trades", "candles"]
    data_timeout_secs = 200
    [[markets]]
    exchange = "binance"
    symbols = ["btcusdt"]
    """
    config = C.read_market_config(spark, text)
    streams = C.market_streams(config)
    assert {(r.exchange, r.symbol, r.feed, r.data_timeout_secs) for r in streams.collect()} == {
        ("okx", "btcusdt", "trades", 200), ("okx", "ethusdt", "trades", 200),
        ("binance", "btcusdt", "orderbook", None), ("binance", "btcusdt", "trades", None)}
    assert C.worker_budget(config).first().workers == 8
    assert C.unknown_feeds(config).count() == 2
    assert {r.channel for r in C.subscription_plan(streams).collect()} == {"trades", "btcusdt@depth20@100ms", "btcusdt@trade"}
