"""Streams that late rows correct, against their batch forms."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tickharbor.operators import quality as Q
from tickharbor.operators.payload import book_of, book_state, current_book
from tickharbor.streaming import corrections as C
from tickharbor.streaming import ingest

SHAPE = "exchange string, symbol string, data_type string, feed string, exchange_sequence_id string, timestamp_collector bigint, n bigint"
KEYS = ["exchange", "symbol", "feed"]


def run(spark, batches, shape, folder, start):
    """Land one file after another, each as a batch of its own, with a restart between them."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        ingest.drain([start(source, f"{folder}/out", f"{folder}/cp")])


@pytest.fixture(scope="module")
def dense():
    rng = random.Random(3)
    rows = []
    for n in range(600):
        venue = rng.choice(["okx", "upbit"])
        rows.append((venue, "btcusdt", "trade", "trades", str(rng.randrange(150)) if n % 50 else None, rng.randrange(20_000) * 1_000_000, n))
    return rows, [[r for r in rows if r[6] % 4 == k] for k in (2, 0, 3, 1)]


def test_first_arrivals_of_any_order_of_batches(spark, tmp_path, dense):
    rows, batches = dense
    # A copy of a whole batch comes again: equal in receipt and tiebreak.
    run(spark, [*batches, batches[0]], SHAPE, tmp_path, lambda s, out, cp: C.first_arrival_stream(s, "n", out, cp))
    got = C.first_arrival_rows(spark, f"{tmp_path}/out", SHAPE, "n").drop("batch")
    expected = Q.first_arrivals(spark.createDataFrame(rows, SHAPE), "n")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    assert spark.read.parquet(f"{tmp_path}/out/batch=4").count() == 0


def test_rows_without_receipt_or_tiebreak_come_last(spark, tmp_path):
    batches = [[("okx", "a", "trade", "trades", "1", None, None)], [("okx", "a", "trade", "trades", "1", 5, None)],
               [("okx", "a", "trade", "trades", "1", 5, 9)], [("okx", "a", "trade", "trades", "1", 6, 1)]]
    run(spark, batches, SHAPE, tmp_path, lambda s, out, cp: C.first_arrival_stream(s, "n", out, cp))
    got = C.first_arrival_rows(spark, f"{tmp_path}/out", SHAPE, "n").select("timestamp_collector", "n", "batch").collect()
    assert [tuple(r) for r in got] == [(5, 9, 2)]


def test_sessions_join_over_batches(spark, tmp_path, dense):
    rows, batches = dense
    run(spark, batches, SHAPE, tmp_path, lambda s, out, cp: C.session_part_stream(s, "n", out, cp))
    expected = Q.sessions(spark.createDataFrame(rows, SHAPE), "n").select(*KEYS, "opened_us", "closed_us", "frames").collect()
    assert 2 < len(expected) < 500
    for hot in (None, 20):
        got = C.joined_sessions(spark, f"{tmp_path}/out", hot_rows=hot).select(*KEYS, "opened_us", "closed_us", "frames").collect()
        assert sorted(got) == sorted(expected)


def test_a_late_row_revises_its_window(spark, tmp_path):
    shape = "exchange string, symbol string, feed string, kind string, timestamp_collector bigint"

    def frames(kind, second, times):
        return [("okx", "a", "trades", kind, second * 1_000_000)] * times

    batches = [frames("trade", 10, 6), frames("error", 130, 1), frames("error", 20, 6) + frames("other", 20, 9), []]
    run(spark, batches, shape, tmp_path, lambda s, out, cp: C.error_count_stream(s, out, cp))
    revised = C.error_revisions(spark, f"{tmp_path}/out", min_samples=5).orderBy("window_us", "revision").collect()
    assert [(r.window_us, r.batch, r.revision, r.errors, r.samples, r.tripped) for r in revised] == [
        (0, 0, 0, 0, 6, False), (0, 2, 1, 6, 12, True), (120_000_000, 1, 0, 1, 1, False)]
    final = C.error_windows(spark, f"{tmp_path}/out", min_samples=5).orderBy("window_us").collect()
    assert [(r.window_us, r.errors, r.samples, r.tripped) for r in final] == [(0, 6, 12, True), (120_000_000, 1, 1, False)]


def test_a_repeated_batch_counts_once(spark, tmp_path, dense):
    rows, batches = dense
    run(spark, batches[:2], SHAPE, tmp_path, lambda s, out, cp: C.first_arrival_stream(s, "n", out, cp))
    before = C.first_arrival_rows(spark, f"{tmp_path}/out", SHAPE, "n").collect()
    # As after a failure between the write of a batch and its commit.
    (tmp_path / "cp" / "commits" / "1").unlink()
    crc = tmp_path / "cp" / "commits" / ".1.crc"
    if crc.exists():
        crc.unlink()
    run(spark, [batches[2]], SHAPE, tmp_path, lambda s, out, cp: C.first_arrival_stream(s, "n", out, cp))
    after = C.first_arrival_rows(spark, f"{tmp_path}/out", SHAPE, "n")
    assert set(after.where(F.col("batch") < 2).collect()) <= set(before)
    expected = Q.first_arrivals(spark.createDataFrame([r for b in batches[:3] for r in b], SHAPE), "n")
    assert sorted(map(repr, after.drop("batch").collect())) == sorted(map(repr, expected.collect()))


def test_the_book_in_steps_is_the_book_of_all_frames(spark, tmp_path):
    rng = random.Random(11)
    shape = "exchange string, symbol string, data_type string, timestamp_collector bigint, timestamp_exchange bigint, data string, n bigint"
    rows = []
    for n in range(300):
        kind = "snapshot" if rng.random() < 0.04 else "delta"
        levels = {side: [[str(rng.randrange(12)), str(rng.randrange(3))] for _ in range(rng.randrange(4))] for side in "ba"}
        rows.append(("bybit", rng.choice("xy"), "orderbook", rng.randrange(200), 0, json.dumps({"type": kind, "data": levels}), n))
    # Batches in no order of time; the state of the last but one is there, older ones are not.
    run(spark, [rows[k::4] for k in (3, 1, 0, 2)], shape, tmp_path, lambda s, out, cp: C.book_stream(s, "n", out, cp))
    expected = current_book(spark.createDataFrame(rows, shape), "n").collect()
    assert len(expected) > 5 and sorted(C.latest_book(spark, f"{tmp_path}/out", "n").collect()) == sorted(expected)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["batch=2", "batch=3"]
    nothing = book_of(book_state(spark.createDataFrame([], shape), "n")).collect()
    assert nothing == []
