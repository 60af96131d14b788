"""Time-series operators against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tickharbor.operators import timeseries as T
from tickharbor.sources.metrics import instant_of, read_samples, write_samples

S = 1_000_000


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(5)
    rows = []
    for host in ("a", "b"):
        ts, value = 0, 0
        for _ in range(120):
            ts += rng.choice([15, 15, 15, 200, 400]) * S
            value = 0 if rng.random() < 0.1 else value + rng.randint(0, 9)
            rows.append((host, ts, float(value)))
    return rows, spark.createDataFrame(rows, "host string, ts_us long, value double")


def ranges(rows, window, step):
    end = max(row[1] for row in rows) + window * S
    for host in {row[0] for row in rows}:
        samples = sorted((ts, value) for name, ts, value in rows if name == host)
        for t in range(step * S, end + 1, step * S):
            inside = [s for s in samples if t - window * S < s[0] <= t]
            if len(inside) > 1:
                yield host, t, inside


def change(before, now):
    return now if now < before else now - before


@pytest.mark.parametrize(("window", "step"), [(300, 60), (60, 60), (60, 300), (300, 70)])
def test_increase_rate_irate(series, window, step):
    rows, vec = series
    expected = {(host, t): sum(change(a[1], b[1]) for a, b in zip(inside, inside[1:], strict=False))
                for host, t, inside in ranges(rows, window, step)}
    got = {(r.host, r.t_us): r.value for r in T.increase(vec, ["host"], window, step).collect()}
    assert got == expected
    assert {(r.host, r.t_us): r.value for r in T.rate(vec, ["host"], window, step).collect()} == {
        key: value / window for key, value in expected.items()}
    last_two = {(host, t): change(inside[-2][1], inside[-1][1]) / ((inside[-1][0] - inside[-2][0]) / S)
                for host, t, inside in ranges(rows, window, step)}
    assert {(r.host, r.t_us): r.value for r in T.irate(vec, ["host"], window, step).collect()} == last_two
    total = {}
    for (_, t), value in expected.items():
        total[t] = total.get(t, 0) + value
    assert {r.t_us: r.value for r in T.increase(vec, ["host"], window, step, by=[]).collect()} == total


def test_instant_age_and_aggregates(series):
    rows, vec = series
    at = 3000 * S
    expected = {host: max((ts, v) for h, ts, v in rows if h == host and ts <= at)[1] for host in ("a", "b")}
    now = T.instant(vec, ["host"], at)
    assert {r.host: r.value for r in now.collect()} == expected
    assert T.instant(vec, ["host"], at, lookback_s=1).count() <= 2
    assert {r.host: r.value for r in T.age(now, at).collect()} == {host: 3000 - value for host, value in expected.items()}
    assert T.sum_by(now).first().value == sum(expected.values())
    assert T.avg_by(now).first().value == sum(expected.values()) / 2
    assert T.count_by(now).first().value == 2


def test_label_matching(spark):
    df = spark.createDataFrame([("m", {"d": "lo"}, 1, 1.0), ("m", {"d": "lox"}, 1, 2.0), ("m", {}, 1, 3.0), ("n", {"d": "lo"}, 1, 4.0)],
                               "metric string, labels map<string,string>, ts_us long, value double")

    def values(*where):
        return sorted(r.value for r in T.vector(df, "m", ["d"], list(where)).collect())

    assert values() == [1, 2, 3]
    assert values(("d", "=", "lo")) == [1]
    assert values(("d", "!=", "lo")) == [2, 3]
    assert values(("d", "=~", "lo|x")) == [1]
    assert values(("d", "!~", "lo.*")) == [3]
    assert values(("d", "=", "")) == [3]


def test_combine_and_either(spark):
    left = spark.createDataFrame([("a", None, 1.0), ("b", "x", 2.0)], "h string, m string, value double")
    right = spark.createDataFrame([("a", None, 10.0), ("c", "x", 20.0)], "h string, m string, value double")
    assert [tuple(r) for r in T.combine(left, right, ["h", "m"], lambda a, b: b - a).collect()] == [("a", None, 9.0)]
    assert sorted(r.value for r in T.either(left, right, ["h", "m"]).collect()) == [1.0, 2.0, 20.0]


def quantile(buckets, q):
    buckets = sorted((math.inf if le == "+Inf" else float(le), n) for le, n in buckets)
    if buckets[-1][0] != math.inf or not buckets[-1][1] or len(buckets) < 2:
        return None
    rank = q * buckets[-1][1]
    i = next(i for i, (_, n) in enumerate(buckets) if n >= rank)
    if i == len(buckets) - 1:
        return buckets[-2][0]
    start, below = (0.0, 0) if i == 0 else buckets[i - 1]
    return start + (buckets[i][0] - start) * ((rank - below) / (buckets[i][1] - below))


def test_histogram_quantile(spark):
    cases = {
        "usual": [("1", 2), ("5", 6), ("10", 6), ("+Inf", 9)], "all in first": [("1", 4), ("5", 4), ("+Inf", 4)],
        "all beyond": [("1", 0), ("5", 0), ("+Inf", 3)], "empty": [("1", 0), ("+Inf", 0)], "no infinity": [("1", 3), ("5", 4)],
        "only infinity": [("+Inf", 4)],
    }
    df = spark.createDataFrame([(k, le, n) for k, rows in cases.items() for le, n in rows], "k string, le string, cumulative long")
    for q in (0.5, 0.95, 0.1):
        got = {r.k: r.value for r in T.histogram_quantile(df, ["k"], q).collect()}
        assert got == {k: quantile(rows, q) for k, rows in cases.items() if quantile(rows, q) is not None}


def test_range_end_is_closed_on_the_right(spark):
    df = spark.createDataFrame([(60 * S,), (60 * S + 1,), (1,)], "ts long")
    assert [r[0] for r in df.select(T.range_end(F.col("ts"), 60)).collect()] == [60 * S, 120 * S, 60 * S]


@pytest.mark.parametrize(("window", "step"), [(300, 120), (60, 60), (60, 90), (100, 70)])
def test_counts_over_steps_with_zeros(series, spark, window, step):
    """Overlapping, adjoining and separate ranges, against a count of each."""
    rows, vec = series
    span = (7 * S, 20_000 * S)
    got = {(r.host, r.t_us): r.value for r in T.event_count(vec, ["host"], window, step, span, "ts_us").collect()}
    times = range(-(-span[0] // (step * S)) * step * S, span[1] + 1, step * S)
    assert got == {(host, t): sum(name == host and t - window * S < ts <= t for name, ts, _ in rows) for host in ("a", "b") for t in times}
    assert 0 in got.values()
    rates = T.event_rate(vec, ["host"], window, step, span, "ts_us").collect()
    assert {(r.host, r.t_us): r.value for r in rates} == {key: n / window for key, n in got.items()}
    quiet = T.event_count(vec.where("host = 'c'"), [], window, step, span, "ts_us", spark.range(1)).collect()
    assert [r.value for r in quiet] == [0] * len(times)


def test_histograms_of_cells_add_up_at_steps(series):
    from tickharbor.operators import quality as Q

    rows, vec = series
    cells = Q.histogram(vec.select("*", T.range_end("ts_us", 60).alias("cell")), ["host", "cell"], F.col("value"), [2, 5, 20])
    got = {(r.host, r.t_us, r.le): r.n for r in T.to_steps(cells, "cell", 300, 120).groupBy("host", "t_us", "le").agg(F.sum("cumulative").alias("n")).collect()}
    for (host, t, le), n in got.items():
        assert n == sum(name == host and t - 300 * S < ts <= t and value <= float(le.replace("+Inf", "inf")) for name, ts, value in rows)
    assert {t for _, t, _ in got} == {t for t in range(0, 40_000 * S, 120 * S) if any(t - 300 * S < ts <= t for _, ts, _ in rows)}


def test_stored_samples_grow_stale_and_only_their_days_are_read(spark, tmp_path):
    day = 86_400 * S
    now = 3 * day + 100 * S
    rows = [(metric, host, k * day + at * S, float(k * 1000 + at)) for metric in ("up", "down") for k in range(4)
            for host, at in (("a", 20), ("b", 101), ("c", 86_399))]
    samples = spark.createDataFrame(rows, "metric string, host string, ts_us bigint, value double") \
        .withColumn("labels", F.create_map(F.lit("host"), "host"))
    write_samples(samples, str(tmp_path))
    stored = read_samples(spark, str(tmp_path))
    at = instant_of(stored, "up", ["host"], now)
    # a is 80 s old, c 101 s and from the day before, b a day; a sample after the time does not count.
    assert {r.host: r.value for r in at.collect()} == {"a": 3020.0, "c": 2000.0 + 86_399}
    assert {r.host for r in instant_of(stored, "up", ["host"], now, lookback_s=100).collect()} == {"a"}
    assert {r.host for r in instant_of(stored, "up", ["host"], now, lookback_s=2 * 86_400).collect()} == {"a", "b", "c"}
    assert [r.host for r in instant_of(stored, "up", ["host"], now, [("host", "=~", "c|d")]).collect()] == ["c"]
    plan = at._jdf.queryExecution().toString()
    filters = plan[plan.rindex("PartitionFilters"):].split("]")[0]
    assert "date#" in filters and "metric#" in filters
    assert stored.count() == len(rows)
