"""Dense seconds: every silent second within the horizon, one row beyond it."""

import random

import pytest
from pyspark.sql import functions as F

from arbiter.operators import series

FAR = 4 * 10 ** 9


def plain(occupied, horizon, start):
    """(sec, seconds, n) by walking the seconds of short silences only."""
    out, at = [], None
    for s in sorted(occupied):
        first = min(start, s) if at is None else at + 1
        out += [(first, s - first, None)] if s - first > horizon else [(x, 1, None) for x in range(first, s)]
        out.append((s, 1, occupied[s]))
        at = s
    return out


@pytest.mark.parametrize("horizon, start", [(0, 0), (1, 25), (7, -3), (1000, 0)])
def test_dense_seconds(spark, horizon, start):
    rng = random.Random(horizon + start)
    occupied = {s: rng.randint(1, 9) for s in rng.sample(range(20, 300), 60)}
    df = spark.createDataFrame([*occupied.items(), (None, 1)], "sec LONG, n INT")
    got = sorted(map(tuple, series.dense_seconds(df, "sec", horizon, start).collect()))
    assert got == plain(occupied, horizon, start)


def test_far_outlier_costs_one_row(spark):
    df = spark.createDataFrame([(0, "a"), (3, None), (FAR, "c")], "sec LONG, seconds_ STRING")
    got = sorted(map(tuple, series.dense_seconds(df, "sec", 10).collect()), key=lambda r: r[0])
    assert got == [(0, 1, "a"), (1, 1, None), (2, 1, None), (3, 1, None), (4, FAR - 4, None), (FAR, 1, "c")]
    assert sum(r[1] for r in got) == FAR + 1  # the rows stand for every second


def test_latency_series_of_an_outlier_and_of_nothing(spark):
    o = spark.createDataFrame([(0, 100000), (FAR * 1000000, 300000), (None, 5)], "t LONG, rt LONG")
    got = sorted(map(tuple, series.latency_series(o, "t", "rt", 0).collect()))
    assert got == [(0, 0.1, 1, 1), (1, 0.0, 0, FAR - 2), (FAR - 1, 0.3, 1, 1)]
    assert series.latency_series(o.limit(0), "t", "rt", 0).collect() == []


def test_plan_has_no_spine(spark):
    df = spark.range(0, 5000, 7).select(F.col("id").alias("sec"))
    plan = series.dense_seconds(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "SortMergeJoin" not in plan
