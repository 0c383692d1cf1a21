"""Properties of the discounted state, the schedule and the distributed ordinal."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from arbiter.operators import discount, policies, series
from arbiter.operators.ordinal import with_ordinal

ROWS = st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.sampled_from(["a", "b", "c"]),
                          st.integers(0, 6), st.integers(0, 5000)), min_size=1, max_size=30)


def _upd(spark, rows):
    df = spark.createDataFrame(rows, "group_id STRING, decision STRING, epoch BIGINT, cents BIGINT")
    return df.withColumn("cost", F.col("cents") / 100)


def _close(got, want):
    """Equal rows, the score sum up to the rounding of a sum of doubles."""
    got, want = sorted(map(tuple, got)), sorted(map(tuple, want))
    assert [(g[:2], g[3]) for g in got] == [(w[:2], w[3]) for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-9)


@settings(max_examples=5, deadline=None)
@given(ROWS)
def test_gamma_one_is_plain_sum_and_zero_is_last_epoch(spark, rows):
    upd = _upd(spark, rows)
    tot = discount.per_epoch_totals(upd)
    last = max(r[2] for r in rows)
    one = discount.discounted_state(tot, 1.0, last).where(F.col("epoch") == last)
    plain = upd.groupBy("group_id", "decision").agg((-F.sum("cents") / 100.0).alias("score_sum"),
                                                    F.count(F.lit(1)).cast("double").alias("cnt"))
    _close(one.select("group_id", "decision", "score_sum", "cnt").collect(), plain.collect())
    zero = discount.discounted_state(tot, 0.0, last).where(F.col("epoch") == last).where("cnt > 0")
    lastonly = plain.join(upd.where(F.col("epoch") == last).select("group_id", "decision").distinct(), ["group_id", "decision"])
    last_tot = upd.where(F.col("epoch") == last).groupBy("group_id", "decision").agg(
        (-F.sum("cents") / 100.0).alias("score_sum"), F.count(F.lit(1)).cast("double").alias("cnt"))
    _close(zero.select("group_id", "decision", "score_sum", "cnt").collect(), last_tot.collect())
    assert lastonly.count() == last_tot.count()


@settings(max_examples=5, deadline=None)
@given(ROWS, st.integers(1, 7))
def test_schedule_has_p_picks_of_known_arms(spark, rows, p):
    st_ = discount.discounted_state(discount.per_epoch_totals(_upd(spark, rows)), 0.5, max(r[2] for r in rows))
    arms = {(g, d) for g, d, _, _ in rows}
    for r in policies.ucb_schedule(st_, p, 0.5).collect():
        picks = r.schedule.split(":")
        assert picks[-1] == "" and len(picks) == p + 1
        assert all((r.group_id, x) in arms for x in picks[:-1])


def test_ordinal_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 5003).alias("v"), "id")
    got = with_ordinal(df, ["v", "id"], partition_by=["k"], partitions=6)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")) - 1)
    j = got.join(want, ["k", "v", "id"])
    assert j.count() == 5000 and j.where("ord != rn").count() == 0


def test_global_ordinal_buckets_and_window_agree(spark):
    df = spark.range(0, 4000).select(((F.col("id") * 7919) % 4001).alias("v"), "id")
    a = with_ordinal(df, ["v", "id"], partitions=5)
    b = with_ordinal(df, ["v", "id"])
    assert a.exceptAll(b).count() == 0 and a.count() == 4000


def test_rolling_mean_matches_window(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("ord"), ((F.col("id") * 37) % 101 / 4).alias("value"))
    got = series.rolling_mean(df, "ord", "value", 60, block=250)
    w = Window.orderBy("ord").rowsBetween(-59, 0)
    want = df.withColumn("want", F.sum(F.col("value").cast("decimal(18,2)")).over(w).cast("double") / F.count(F.lit(1)).over(w))
    j = got.join(want, "ord")
    assert j.count() == 3000 and j.where("rolling_mean != want").count() == 0


def test_block_fold_equals_a_loop(spark):
    from arbiter import adapters as ad
    upd = ad.updates(ad.table(spark, "/root/testdata/sf0.001", "events"))
    tot = discount.per_epoch_totals(upd)
    for reset in (None, 15):
        got = discount.discounted_state(tot, 0.9, 299, reset_period=reset)   # several blocks, a long silent tail
        want, arms = {}, {}
        for r in tot.collect():
            arms.setdefault((r.group_id, r.decision), {})[r.epoch] = (r.xs, r.xc)
        for arm, x in arms.items():
            now = None
            for e in range(300):
                if reset and e % reset == 0:
                    now = None
                if e in x:
                    now = x[e] if now is None else (x[e][0] + now[0] * 0.9, x[e][1] + now[1] * 0.9)
                elif now is not None:
                    now = (now[0] * 0.9, now[1] * 0.9)
                if now is not None and (not reset or e // reset in {d // reset for d in x}):
                    want[(*arm, e)] = now
        assert {(r.group_id, r.decision, r.epoch): (r.score_sum, r.cnt) for r in got.collect()} == want


def test_counts_conserve_and_block_means_times_n_is_sum(spark):
    from arbiter import adapters as ad
    from arbiter.operators import aggregates as agg
    upd = ad.updates(ad.table(spark, "/root/testdata/sf0.001", "events"))
    n = upd.count()
    assert agg.arm_totals(upd).agg(F.sum("cnt")).first()[0] == n
    st = discount.discounted_state(discount.per_epoch_totals(upd), 1.0, 119)
    assert st.where(F.col("epoch") == 119).agg(F.sum("cnt")).first()[0] == n
    s = with_ordinal(upd.select("event_id", "cost"), ["event_id"], partitions=3)
    blocks = series.block_means(s, "ord", "cost", 60)
    full = s.where(F.col("ord") < blocks.count() * 60).agg(F.sum(F.col("cost").cast("decimal(18,2)"))).first()[0]
    total = blocks.agg(F.sum(F.round(F.col("mean_value") * 60, 2).cast("decimal(18,2)"))).first()[0]
    assert total == full
