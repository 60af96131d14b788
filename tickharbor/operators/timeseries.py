"""Time-series operators on metric samples.

A *vector* is a DataFrame of label columns, ``ts_us`` and ``value``; an evaluated vector
has ``t_us``, the evaluation time, in place of ``ts_us``. A range at ``t`` covers
``(t - w, t]`` and uses only the samples inside it, without extrapolating to its edges.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickharbor.functions.scalars import whole
from tickharbor.operators.ordered import Previous, with_previous

SECOND = 1_000_000


# --- selection --------------------------------------------------------------------------------

def label_matches(label: Column, operator: str, value: str) -> Column:
    """``=``, ``!=``, ``=~`` or ``!~`` on a label. A missing label is empty text; patterns match the whole value."""
    label = F.coalesce(label, F.lit(""))
    if operator == "=":
        return label == value
    if operator == "!=":
        return label != value
    matched = label.rlike(f"^(?:{value})$")
    return matched if operator == "=~" else ~matched


def vector(samples: DataFrame, metric: str, labels: list[str], where: list[tuple[str, str, str]] = ()) -> DataFrame:
    """Samples of one metric with the named labels as columns."""
    picked = samples.where(F.col("metric") == metric)
    for label, operator, value in where:
        picked = picked.where(label_matches(F.col("labels")[label], operator, value))
    return picked.select(*[F.col("labels")[label].alias(label) for label in labels], "ts_us", "value")


# --- evaluation -------------------------------------------------------------------------------

def instant(vec: DataFrame, labels: list[str], at_us: int, lookback_s: int | None = None) -> DataFrame:
    """The latest sample of every series at a time, optionally no older than a bound."""
    seen = vec.where(F.col("ts_us") <= at_us)
    if lookback_s is not None:
        seen = seen.where(F.col("ts_us") > at_us - lookback_s * SECOND)
    return seen.groupBy(*labels).agg(F.max_by("value", "ts_us").alias("value"))


def age(vec: DataFrame, at_us: int) -> DataFrame:
    """Evaluation time in seconds minus a value that is itself a time in seconds."""
    return vec.withColumn("value", F.lit(at_us / SECOND) - F.col("value"))


def steps(ts_us: Column, window_s: int, step_s: int) -> Column:
    """All multiples of the step whose range holds a sample at ``ts_us``."""
    step, window = step_s * SECOND, window_s * SECOND
    first = whole(ts_us + (step - 1), step) * step
    after = ts_us + window
    return F.when(first < after, F.sequence(first, after - 1, F.lit(step).cast("bigint")))


def _pairs(vec: DataFrame, labels: list[str], window_s: int, step_s: int) -> DataFrame:
    """Neighbouring samples inside each evaluation range, with the change adjusted for counter resets.

    The number of evaluation times per sample is window / step, fixed by the query and
    not by the data; the copies are summed up before any shuffle.
    """
    linked = with_previous(vec, labels, ["ts_us"], {
        "__before": Previous("last", "value"), "__before_us": Previous("last", "ts_us")})
    change = F.when(F.col("value") < F.col("__before"), F.col("value")).otherwise(F.col("value") - F.col("__before"))
    ranged = linked.where(F.col("__before_us").isNotNull()).select(
        *labels, "ts_us", "__before_us", change.alias("change"), F.explode(steps(F.col("ts_us"), window_s, step_s)).alias("t_us"))
    return ranged.where(F.col("__before_us") > F.col("t_us") - window_s * SECOND)


def increase(vec: DataFrame, labels: list[str], window_s: int, step_s: int, by: list[str] | None = None) -> DataFrame:
    """Growth of counters over a range, per series or summed over the labels not in ``by``.

    A range needs two samples of a series; with fewer that series has no value there.
    """
    return _pairs(vec, labels, window_s, step_s).groupBy(*(labels if by is None else by), "t_us").agg(
        F.sum("change").alias("value"))


def rate(vec: DataFrame, labels: list[str], window_s: int, step_s: int, by: list[str] | None = None) -> DataFrame:
    """Increase per second. Summing before the division gives the sum of the rates."""
    return increase(vec, labels, window_s, step_s, by).withColumn("value", F.col("value") / window_s)


def irate(vec: DataFrame, labels: list[str], window_s: int, step_s: int) -> DataFrame:
    """Change per second between the last two samples of a range."""
    per_second = F.col("change") / ((F.col("ts_us") - F.col("__before_us")) / SECOND)
    return _pairs(vec, labels, window_s, step_s).groupBy(*labels, "t_us").agg(
        F.max_by(per_second, "ts_us").alias("value"))


# --- aggregation over series ------------------------------------------------------------------

def _time(vec: DataFrame) -> list[str]:
    return ["t_us"] if "t_us" in vec.columns else []


def sum_by(vec: DataFrame, by: list[str] = ()) -> DataFrame:
    return vec.groupBy(*by, *_time(vec)).agg(F.sum("value").alias("value"))


def avg_by(vec: DataFrame, by: list[str] = ()) -> DataFrame:
    return vec.groupBy(*by, *_time(vec)).agg(F.avg("value").alias("value"))


def count_by(vec: DataFrame, by: list[str] = ()) -> DataFrame:
    return vec.groupBy(*by, *_time(vec)).agg(F.count("*").alias("value"))


# --- between vectors --------------------------------------------------------------------------

def combine(left: DataFrame, right: DataFrame, labels: list[str], operation) -> DataFrame:
    """``operation(left value, right value)`` for series with equal labels (and equal time)."""
    keys = [*labels, *_time(left)]
    other = right.select(*[F.col(key).alias(f"__{key}") for key in keys], F.col("value").alias("__value"))
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys])
    return left.join(other, same).select(*keys, operation(F.col("value"), F.col("__value")).alias("value"))


def either(first: DataFrame, fallback: DataFrame, labels: list[str]) -> DataFrame:
    """All series of the first vector, and those of the fallback that it lacks."""
    keys = [*labels, *_time(first)]
    other = first.select(*[F.col(key).alias(f"__{key}") for key in keys])
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys])
    return first.select(*keys, "value").unionByName(fallback.join(other, same, "left_anti").select(*keys, "value"))


def histogram_quantile(buckets: DataFrame, by: list[str], quantile: float, value: str = "cumulative") -> DataFrame:
    """Quantile of cumulative buckets by linear interpolation inside the bucket it falls into.

    ``buckets`` has one row per (by, le). The list that is collected is as long as the
    histogram has bounds. Beyond the last finite bound the answer is that bound; without
    observations or without a +Inf bucket there is none.
    """
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    summed = buckets.groupBy(*by, bound.alias("le")).agg(F.sum(value).cast("double").alias("n"))
    listed = summed.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("le", "n"))).alias("b"))
    listed = listed.withColumn("rank", F.element_at("b", -1)["n"] * quantile)
    ranked = listed.withColumn("i", F.array_position(F.transform("b", lambda x: x["n"] >= F.col("rank")), True).cast("int"))
    here, before = F.element_at("b", F.col("i")), F.when(F.col("i") > 1, F.get("b", F.col("i") - 2))
    start = F.when(F.col("i") > 1, before["le"]).otherwise(0.0)
    below = F.when(F.col("i") > 1, before["n"]).otherwise(0.0)
    # Quantile 0 falls into the first bucket even if that is empty: the answer is its lower end.
    share = F.coalesce(F.try_divide(F.col("rank") - below, here["n"] - below), F.lit(0.0))
    interpolated = start + (here["le"] - start) * share
    answer = F.when(here["le"] == float("inf"), before["le"]) \
        .when((F.col("i") == 1) & (here["le"] <= 0), here["le"]).otherwise(interpolated)
    usable = (F.element_at("b", -1)["le"] == float("inf")) & (F.element_at("b", -1)["n"] > 0) & (F.size("b") > 1)
    return ranked.where(usable).select(*by, answer.alias("value"))


# --- straight from events ---------------------------------------------------------------------

def range_end(ts_us: Column | str, window_s: int) -> Column:
    """End of the tumbling range ``(t - w, t]`` that holds a time."""
    ts_us = F.col(ts_us) if isinstance(ts_us, str) else ts_us
    width = window_s * SECOND
    return whole(ts_us + (width - 1), width) * width


def over_steps(df: DataFrame, by: list[str], sums: dict[str, Column], window_s: int, step_s: int, ts: str,
               span: tuple[int, int] | None = None) -> DataFrame:
    """Sums over the range ``(t - w, t]`` at every multiple ``t_us`` of the step whose range holds a row.

    Rows are added up by cell first: cells are as long as the greatest common divisor of window and step, so that each
    range is a whole number of them, and only cells are copied to the steps that they belong to. ``sums`` names
    counts and sums; ``span`` keeps steps from its first to its last.
    """
    cells = df.groupBy(*by, range_end(ts, math.gcd(window_s, step_s)).alias("__cell_us")).agg(
        *[column.alias(name) for name, column in sums.items()])
    return to_steps(cells, "__cell_us", window_s, step_s, span).groupBy(*by, "t_us").agg(*[F.sum(name).alias(name) for name in sums])


def to_steps(cells: DataFrame, cell_us: str, window_s: int, step_s: int, span: tuple[int, int] | None = None) -> DataFrame:
    """Copy cells, known by their ends, to the steps ``t_us`` whose range they lie in."""
    spread = cells.withColumn("t_us", F.explode(steps(F.col(cell_us), window_s, step_s))).drop(cell_us)
    return spread if span is None else spread.where(F.col("t_us").between(*span))


def with_zeros(vec: DataFrame, by: list[str], series: DataFrame, step_s: int, span: tuple[int, int]) -> DataFrame:
    """The vector with the value 0 at every step of the span where a series has none.

    ``series`` has the labels of all series. Zeros are added, not joined: one shuffle, summed before it.
    """
    step = step_s * SECOND
    grid = F.explode(F.sequence(F.lit(-(-span[0] // step) * step).cast("bigint"), F.lit(span[1]).cast("bigint"), F.lit(step).cast("bigint")))
    value = F.lit(0).cast(vec.schema["value"].dataType).alias("value")
    zeros = series.select(*by).distinct().select(*by, grid.alias("t_us"), value) if by else series.limit(1).select(grid.alias("t_us"), value)
    return vec.select(*by, "t_us", "value").unionByName(zeros).groupBy(*by, "t_us").agg(F.sum("value").alias("value"))


def event_count(events: DataFrame, by: list[str], window_s: int, step_s: int, span: tuple[int, int], ts: str = "timestamp_collector",
                series: DataFrame | None = None) -> DataFrame:
    """Rows in the range of each step, 0 where there are none, counted exactly from the events themselves.

    ``series`` has the labels of all series; by default, of all that occur.
    """
    counted = over_steps(events, by, {"value": F.count("*")}, window_s, step_s, ts, span)
    return with_zeros(counted, by, events if series is None else series, step_s, span)


def event_rate(events: DataFrame, by: list[str], window_s: int, step_s: int, span: tuple[int, int], ts: str = "timestamp_collector",
               series: DataFrame | None = None) -> DataFrame:
    """Rows per second in the range of each step."""
    return event_count(events, by, window_s, step_s, span, ts, series).withColumn("value", F.col("value") / window_s)
