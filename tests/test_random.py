"""Random choices (seeded hashes): membership, distribution within tolerance, repeatability."""

from pyspark.sql import functions as F

from arbiter.operators import serving
from arbiter.operators.sampling import sample_rows


def test_hash_sample_fraction_and_repeatability(spark):
    df = spark.range(0, 200000)
    a = sample_rows(df, "id", 0.01, method="hash", seed=7)
    n = a.count()
    assert 1700 <= n <= 2300                       # ~1 % within tolerance
    assert a.exceptAll(sample_rows(df, "id", 0.01, method="hash", seed=7)).count() == 0   # repeatable
    assert sample_rows(df, "id", 0.01, method="hash", seed=8).join(a, "id").count() < n   # seed matters
    dup = spark.range(0, 1000).select(F.lit("same").alias("v"), "id")
    kept = sample_rows(dup, "id", 0.5, method="hash").count()
    assert 0 < kept < 1000                          # equal values are not kept or dropped together


def test_seeded_schedule_picks(spark):
    req = spark.range(0, 20000).select(F.col("id").alias("req_id"))
    sched = F.lit("a:a:b:")                          # repeats weight the pick: a twice as often as b
    offered = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    p = serving.schedule_pick(sched, offered, serving.seeded_int("req_id", 1, 1 << 30),
                              serving.seeded_int("req_id", 2, 1 << 30))
    out = req.select("req_id", p["decision"].alias("d"))
    counts = dict(out.groupBy("d").count().collect())
    assert set(counts) <= {"a", "b"}
    assert 1.8 < counts["a"] / counts["b"] < 2.2
    again = req.select("req_id", p["decision"].alias("d"))
    assert out.exceptAll(again).count() == 0
    not_offered = req.select(serving.schedule_pick(F.lit("x:"), offered, F.col("req_id"), F.col("req_id"))["decision"].alias("d"))
    assert {r.d for r in not_offered.distinct().collect()} == {"a", "b", "c"}   # fallback: uniform over the offer
