"""Decision policies (A7-A9, O3, U3): greedy / epsilon-greedy and discounted UCB.

Each group's arms are gathered into one small array (bounded by the number of options of the
group) and the policy runs as Catalyst higher-order functions: no UDF, groups in parallel.
Ties go to the smallest decision name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import decision_message, eg_payload
from .aggregates import guarded_mean

UCB_SCALE = 1000.0  # fixed value: bonus = 1000 * sqrt(2 ln N) / sqrt(cnt)


def best_arm(totals: DataFrame, keys=("group_id",), mean: str = "mean_score",
             decision: str = "decision") -> DataFrame:
    """Best option by mean (ties: smallest name) and the sorted list of the others."""
    g = (totals.groupBy(*keys)
         .agg(F.min_by(F.col(decision), F.struct(-F.col(mean), F.col(decision))).alias("best"),
              F.array_sort(F.collect_list(decision)).alias("_all")))
    return g.select(*keys, "best", F.array_except("_all", F.array("best")).alias("others"))


def eg_message(best: DataFrame, epsilon: float, origin: str, group: str = "group_id") -> Column:
    """E13 + C6 payload of the epsilon-greedy decision maker."""
    return decision_message(F.col(group), eg_payload(F.col("best"), F.col("others"), epsilon), origin)


def ucb_bonus(n: Column) -> Column:
    return F.when(n > 1, F.lit(UCB_SCALE) * F.sqrt(F.lit(2.0) * F.ln(n.cast("double")))).otherwise(F.lit(0.0))


def ucb_score(mean: Column, cnt: Column, n: Column) -> Column:
    """Mean + bonus / sqrt(cnt); 0 when cnt <= 0."""
    return F.when(cnt > 0, mean + ucb_bonus(n) / F.sqrt(cnt)).otherwise(F.lit(0.0))


def with_means(state: DataFrame) -> DataFrame:
    return state.withColumn("mean_score", guarded_mean("score_sum", "cnt"))


def ucb_scores(state: DataFrame, keys=("group_id", "epoch")) -> DataFrame:
    """A6 + A9 per arm, with the rank of the arm in its group (1 = best)."""
    w = Window.partitionBy(*keys)
    s = with_means(state).withColumn("n_eff", F.sum(F.floor("cnt")).over(w).cast("bigint"))
    s = s.withColumn("ucb", ucb_score(F.col("mean_score"), F.col("cnt"), F.col("n_eff")))
    return s.withColumn("rank", F.row_number().over(w.orderBy(F.col("ucb").desc(), F.col("decision"))))


ARM_T = "array<struct<decision:string,mean:double,cnt:double>>"


def ucb_schedule(state: DataFrame, picks: int, gamma: float, keys=("group_id", "epoch")) -> DataFrame:
    """P sequential argmax picks per group with a simulated count update.

    Per pick: bonus from the running N; best = argmax score (strict >, arms in name order);
    best.cnt += 1; N += 1; every cnt *= gamma. Output ``keys, n_eff, schedule`` with the
    schedule as ``d1:d2:...:``.
    """
    g = F.lit(float(gamma))
    arms = (with_means(state).groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("decision"), F.col("mean_score").alias("mean"),
                                                      F.col("cnt")))).alias("arms"),
                 F.sum(F.floor("cnt")).cast("bigint").alias("n_eff")))

    def pick(acc: Column, _k: Column) -> Column:
        n = acc["n"]
        scored = F.transform(acc["arms"], lambda a: F.struct(a["decision"].alias("d"),
                                                              ucb_score(a["mean"], a["cnt"], n).alias("v")))
        best = F.aggregate(F.slice(scored, 2, F.greatest(F.size(scored) - 1, F.lit(0))), F.get(scored, 0),
                           lambda b, a: F.when(a["v"] > b["v"], a).otherwise(b))["d"]
        new_arms = F.transform(acc["arms"], lambda a: F.struct(
            a["decision"].alias("decision"), a["mean"].alias("mean"),
            (F.when(a["decision"] == best, a["cnt"] + 1).otherwise(a["cnt"]) * g).alias("cnt")))
        return F.struct(new_arms.alias("arms"), (n + 1).alias("n"),
                        F.concat(acc["out"], best, F.lit(":")).alias("out"))

    init = F.struct(F.col("arms").cast(ARM_T).alias("arms"), F.col("n_eff").alias("n"), F.lit("").alias("out"))
    sched = F.aggregate(F.sequence(F.lit(1), F.lit(int(picks))), init, pick)["out"]
    return arms.select(*keys, "n_eff", sched.alias("schedule"))


def reset_payload(schedule: Column, epoch: Column, period: int) -> Column:
    """The last epoch of every reset segment emits ``random`` instead of a schedule."""
    return F.when((epoch + 1) % period == 0, F.lit("random")).otherwise(schedule)
