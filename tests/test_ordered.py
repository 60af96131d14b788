"""State carried over slices of a hot key must equal a plain window and brute force."""

import random

import pytest

from tickharbor.operators import quality as Q
from tickharbor.operators.ordered import Previous, with_previous
from tickharbor.operators.rotation import rotation_files

SCHEMA = "exchange string, symbol string, feed string, data_type string, exchange_sequence_id string, timestamp_collector long, event_id long, value long"


def make_rows(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.6
        symbol = "hot" if hot else rng.choice("abc")
        rows.append(("binance", symbol, "trades", "trade", str(rng.randint(1, 300)), rng.randint(0, 40) * 37_000_000, i,
                     rng.choice([None, rng.randint(0, 99)])))
    return rows


@pytest.fixture(scope="module")
def events(spark):
    rows = make_rows(1)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain_states(rows):
    state, out = {}, {}
    for row in sorted(rows, key=lambda r: (r[1], r[5], r[6])):
        last, most, total = state.get(row[1], (None, None, None))
        if row[7] is not None:
            total = row[7] + (total or 0)
        out[row[6]] = (last, most, total)
        if row[7] is not None:
            last, most = row[7], row[7] if most is None else max(most, row[7])
        state[row[1]] = (last, most, total)
    return out


@pytest.mark.parametrize("hot_rows", [10_000, 40])
def test_with_previous(events, hot_rows):
    rows, df = events
    states = {"last": Previous("last", "value"), "most": Previous("max", "value"), "total": Previous("sum", "value")}
    result = with_previous(df, ["symbol"], ["timestamp_collector", "event_id"], states, hot_rows)
    assert {row.event_id: (row.last, row.most, row.total) for row in result.collect()} == plain_states(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_sequence_check_is_the_same_in_slices(spark, seed):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    plain = Q.sequence_check(df, "event_id").collect()
    sliced = Q.sequence_check(df, "event_id", hot_rows=30).collect()
    assert sorted(plain) == sorted(sliced)
    highest, expected = {}, {}
    for row in sorted(rows, key=lambda r: (r[5], r[6])):
        key, current = row[1], int(row[4])
        before = highest.get(key)
        expected[row[6]] = ("first" if before is None else "duplicate" if current == before else "out_of_order" if current < before
                            else "gap" if current > before + 1 else "ok")
        highest[key] = current if before is None else max(before, current)
    assert {row.event_id: row.result for row in plain} == expected


def test_sessions_and_silence_are_the_same_in_slices(events):
    _, df = events
    from pyspark.sql import functions as F

    timed = df.withColumn("timeout_s", F.lit(60).cast("bigint"))
    assert sorted(Q.sessions(df, "event_id").collect()) == sorted(Q.sessions(df, "event_id", hot_rows=30).collect())
    assert sorted(Q.stale_periods(timed, "event_id").collect()) == sorted(Q.stale_periods(timed, "event_id", hot_rows=30).collect())
    parsed = df.withColumn("kind", F.when(F.col("event_id") % 5 == 0, "pong").otherwise("trade"))
    key = lambda row: (row.symbol, row.event_id)
    assert sorted(Q.disconnect_diagnostics(parsed, "event_id").collect(), key=key) == sorted(
        Q.disconnect_diagnostics(parsed, "event_id", hot_rows=30).collect(), key=key)


def files_of(rows, age, most=None, look=None):
    """(key, opening, last time, rows, bytes): one row after another."""
    files, opened = [], {}
    for row in sorted(rows, key=lambda r: (r[5], r[6])):
        key = (row[0], row[1], row[3])
        file = opened.get(key)
        full = file and most is not None and file[5] % look == 0 and file[6] > most
        if not file or row[5] - file[3] > age or full:
            file = opened[key] = [*key, row[5], row[5], 0, 0]
            files.append(file)
        file[4], file[5], file[6] = row[5], file[5] + 1, file[6] + len(row[4])
    return sorted(map(tuple, files), key=str)


@pytest.mark.parametrize("slice_rows, age", [(10_000, 100_000_000), (60, 100_000_000), (1, 38_000_000), (1, 3_000_000_000)])
def test_rotation_by_age(events, slice_rows, age):
    rows, df = events
    result = rotation_files(df, age_us=age, slice_rows=slice_rows)
    assert result.columns == ["exchange", "symbol", "data_type", "opened_us", "last_us", "rows"]
    assert sorted((tuple(row) for row in result.collect()), key=str) == [f[:-1] for f in files_of(rows, age)]


@pytest.mark.parametrize("slice_rows, look, most", [(10_000, 10, 24.5), (60, 7, 30), (1, 7, 40), (1, 1, 0), (1, 20, 30)])
def test_rotation_by_age_and_size(spark, slice_rows, look, most):
    from pyspark.sql import functions as F

    rows = [row[:1] + (None,) + row[2:] if row[1] == "a" else row for row in make_rows(look, 400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    age = 150_000_000
    result = rotation_files(df, age_us=age, size=F.length("exchange_sequence_id"), max_bytes=most * 2, ratio=2.0, look_rows=look,
                            tiebreak="event_id", slice_rows=slice_rows)
    expected = files_of([r[:1] + (r[1] or "",) + r[2:] for r in rows], age, most, look)
    assert len(expected) > len(files_of([r[:1] + (r[1] or "",) + r[2:] for r in rows], age)) + 2
    assert sorted(((r[0], r[1] or "", *r[2:]) for r in result.collect()), key=str) == expected


def test_rotation_takes_as_many_rounds_as_slices_have_digits(spark, monkeypatch):
    """Four times the rows in the same time: the same tables are written."""
    from tickharbor.operators import rotation
    from tickharbor.session import stored

    counts = []
    for copies in (1, 4):
        names = []
        monkeypatch.setattr(rotation, "stored", lambda df, name, names=names: names.append(name) or stored(df, name))
        rows = [row[:6] + (row[6] * copies + c, row[7]) for row in make_rows(5, 300) for c in range(copies)]
        files = rotation.rotation_files(spark.createDataFrame(rows, SCHEMA), age_us=38_000_000, slice_rows=1).count()
        assert files > 10
        counts.append(names)
    assert counts[0] == counts[1]
    assert counts[0].count("rotation-jumps") <= 5


def test_rotation_of_an_empty_table(spark):
    assert rotation_files(spark.createDataFrame([], SCHEMA)).collect() == []


def test_first_arrivals_keeps_one_of_each(events):
    rows, df = events
    kept = {(row.symbol, row.exchange_sequence_id): row.event_id for row in Q.first_arrivals(df, "event_id").collect()}
    expected = {}
    for row in sorted(rows, key=lambda r: (r[5], r[6])):
        expected.setdefault((row[1], row[4]), row[6])
    assert kept == expected
    dropped = sum(row.dropped for row in Q.duplicates_dropped(df).collect())
    assert dropped == len(rows) - len(expected)
    plan = Q.first_arrivals(df, "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("hot_rows", [10_000, 40])
def test_message_timeouts(events, spark, hot_rows):
    """Silences between rows, before the first and after the last; a stream without rows, one that is not configured."""
    rows, df = events
    streams = [("binance", "hot", "trades", 20), ("binance", "a", "trades", 12), ("binance", "b", "trades", 1000), ("okx", "never", "trades", 30)]
    since, until = -500_000_000, 1_700_000_000
    got = Q.message_timeouts(df, spark.createDataFrame(streams, "exchange string, symbol string, feed string, timeout_s long"), since, until,
                             hot_rows=hot_rows).collect()
    expected = []
    for exchange, symbol, feed, timeout in streams:
        times = sorted({r[5] for r in rows if r[1] == symbol})
        for i, (start, end) in enumerate(zip([since, *times], [*times, until])):
            at = start + timeout * 3_000_000
            while at < end:
                expected.append((exchange, symbol, feed, "stalled" if i else "never_received", start, at))
                at += timeout * 3_000_000
    assert sorted(map(tuple, got)) == sorted(expected)
    assert {r.cause for r in got} == {"stalled", "never_received"}
    assert max(r.at_us for r in got if r.symbol == "hot") > max(r[5] for r in rows if r[1] == "hot")


def test_breaker_trips(spark):
    """Windows open with a row; the circuit opens at the first error with enough samples and a high enough share."""
    minute = 60_000_000
    rows = [(i * 100_000, "error" if i % 2 else "trade") for i in range(300)]  # 150th sample within the first window
    rows += [(200 * minute + i * 100_000, "error" if i < 40 else "trade") for i in range(300)]  # many errors, too early
    rows += [(400 * minute + i * 100_000, "trade" if i < 98 else "error") for i in range(200)]  # half only at the end
    df = spark.createDataFrame([("okx", "btc", "trades", t, i, kind) for i, (t, kind) in enumerate(rows)],
                               "exchange string, symbol string, feed string, timestamp_collector long, event_id long, kind string")
    got = [(r.opened_us, r.tripped_us) for r in Q.breaker_trips(Q.breaker_checks(df, "event_id")).orderBy("opened_us").collect()]
    assert got == [(0, 99 * 100_000), (400 * minute, 400 * minute + 195 * 100_000)]


def counted_once(spark, df):
    """A table that counts its rows whenever they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


@pytest.mark.parametrize("slice_rows", [10_000, 1])
def test_rotation_computes_its_events_once(spark, slice_rows):
    rows = make_rows(3, 200)
    df, seen = counted_once(spark, spark.createDataFrame(rows, SCHEMA))
    assert rotation_files(df, age_us=38_000_000, slice_rows=slice_rows).count() > 1
    assert seen.value == len(rows)


def test_breaker_computes_its_frames_once(spark):
    rows = [("okx", "btc", "trades", i * 100_000, i, "error" if i % 2 else "trade") for i in range(300)]
    df, seen = counted_once(spark, spark.createDataFrame(rows, "exchange string, symbol string, feed string, timestamp_collector long, event_id long, kind string"))
    assert Q.breaker_trips(Q.breaker_checks(df, "event_id")).count() == 1
    assert seen.value == len(rows)
