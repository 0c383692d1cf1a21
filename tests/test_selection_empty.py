"""Selection by counting, and every query of the library on empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from arbiter.adapters import TABLES
from arbiter.operators import series
from arbiter.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("span", [0, 1, 5, 3000, 10 ** 9, 2 ** 64 - 1])
def test_nth_smallest(spark, span):
    rng = random.Random(span)
    values = [-(2 ** 63) + rng.randint(0, span) for _ in range(60)] if span > 10 ** 10 else [rng.randint(-7, -7 + span) for _ in range(60)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v LONG")
    for num in (0, 1, 5, 9):
        assert tuple(series.percentile_at(df, "v", num, 10).first()) == (60, sorted(values)[num * 60 // 10])
    assert series.percentile_at(df, "v", 10, 10).collect() == []
    assert series.percentile_at(df.where("v is null"), "v", 9, 10).collect() == []


def test_selection_doesnt_sort(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 7919 % 1009)
    seen = []
    real = type(df).collect
    try:
        type(df).collect = lambda self: (seen.append(self._jdf.queryExecution().executedPlan().toString()), real(self))[1]
        series.percentile_at(df, "v", 9, 10).first()
    finally:
        type(df).collect = real
    assert seen and not any("rangepartitioning" in p or "Window" in p for p in seen)
    with pytest.raises(TypeError):
        series.percentile_at(df.withColumn("v", F.lit(0.5)), "v", 9, 10)
    assert abs(series.percentile_sketch(df, "v", 0.9).first().p - series.percentile_at(df, "v", 9, 10).first().p) <= 2


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{path}/{t}.parquet")
    return str(path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    """No rows, or the one row of a total over nothing."""
    out = QUERIES[name](spark, empty_dir)
    assert out.columns and len(out.collect()) <= 2
