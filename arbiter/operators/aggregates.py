"""Keyed aggregations.

All are plain ``groupBy().agg()``: Spark plans a partial (map-side) aggregate before the
shuffle, so a hot key is combined per input partition before any exchange.
Costs are summed as exact decimals and converted to double at the end.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import exact


def score_sum(cost: str = "cost") -> Column:
    """Sum of scores (score = 0 - cost), exact."""
    return (-F.sum(exact(cost))).cast("double")


def arm_totals(updates: DataFrame, keys: Sequence[str] = ("group_id", "decision"),
               cost: str = "cost") -> DataFrame:
    """A1 + A5: per key, score sum, count and mean score (zero-count guarded)."""
    return (updates.groupBy(*keys)
            .agg(score_sum(cost).alias("score_sum"), F.count(F.lit(1)).alias("cnt"))
            .withColumn("mean_score", guarded_mean("score_sum", "cnt")))


def guarded_mean(s: str | Column, c: str | Column) -> Column:
    """A5: sum / count, 0 when the count is not positive."""
    s = F.col(s) if isinstance(s, str) else s
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, s / c).otherwise(F.lit(0.0))


def sliding_arm_totals(updates: DataFrame, window: str, slide: str, ts: str = "ts",
                       keys: Sequence[str] = ("group_id", "decision"), weight: str | None = None) -> DataFrame:
    """A2: sliding-window score sum and count per (window, keys).

    ``weight`` (optional) is a row multiplicity: a seed row standing for n copies (S18).
    Rows are summed once per pane (the common divisor of window and slide); only the panes' totals are copied
    into the windows that hold them.
    """
    size, step = (int(pd.Timedelta(x).total_seconds()) for x in (window, slide))
    pane = math.gcd(size, step)
    w = F.col(weight) if weight else F.lit(1)
    at = (F.floor(F.unix_seconds(ts) / pane) * pane).cast("bigint")
    panes = updates.groupBy(at.alias("_at"), *keys).agg(F.sum(exact("cost") * w).alias("_s"), F.sum(w).cast("bigint").alias("_n"))
    last = (F.floor(F.col("_at") / step) * step).cast("bigint")  # the latest window that has begun
    starts = F.sequence(last, F.col("_at") - size + pane, F.lit(-step).cast("bigint"))
    spread = panes.where(last >= F.col("_at") - size + pane).select("*", F.explode(starts).alias("window_start"))
    return (spread.groupBy("window_start", *keys)
            .agg((-F.sum("_s")).cast("double").alias("score_sum"), F.sum("_n").alias("cnt"))
            .select("window_start", (F.col("window_start") + size).alias("window_end"), *keys, "score_sum", "cnt"))


def sliding_arm_stream(updates: DataFrame, window: str, slide: str, ts: str = "ts",
                       keys: Sequence[str] = ("group_id", "decision"), weight: str | None = None) -> DataFrame:
    """A2 over a stream: two chained stateful aggregates, both closed by the watermark.

    Rows are summed once per pane (the common divisor of window and slide); a closed pane's totals go to the
    windows that hold it. So a row touches one state row, not one per window. Append mode only.
    """
    w = F.col(weight) if weight else F.lit(1)
    size, step = (int(pd.Timedelta(x).total_seconds()) for x in (window, slide))
    panes = (updates.groupBy(F.window(ts, f"{math.gcd(size, step)} seconds").alias("_pane"), *keys)
             .agg(F.sum(exact("cost") * w).alias("_s"), F.sum(w).cast("bigint").alias("_n")))
    return (panes.groupBy(F.window(F.window_time("_pane"), window, slide).alias("w"), *keys)
            .agg((-F.sum("_s")).cast("double").alias("score_sum"), F.sum("_n").alias("cnt"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"),
                    F.unix_seconds(F.col("w.end")).alias("window_end"), *keys, "score_sum", "cnt"))


def effective_n(state: DataFrame, keys: Sequence[str] = ("group_id", "epoch")) -> DataFrame:
    """N = sum of floor(count) per key (the reference accumulates into an int)."""
    return state.groupBy(*keys).agg(F.sum(F.floor("cnt")).cast("bigint").alias("n_eff"),
                                    F.count(F.lit(1)).alias("n_arms"))


def records_per_batch(df: DataFrame, batch: str = "epoch") -> DataFrame:
    """Records handled per drain / batch id."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("n_records"))


def feature_frequency(pairs: DataFrame) -> DataFrame:
    """A10 (after sampling and E15): counts per (feature_index, feature_value)."""
    return pairs.groupBy("feature_index", "feature_value").agg(F.count(F.lit(1)).alias("n"))


def run_rollup(headers: DataFrame, sent: str = "sent", dur_us: str = "dur_us") -> DataFrame:
    """Total sent, mean duration (s) and offered rate across workers (integer micros)."""
    n = F.count(F.lit(1))
    mean_s = F.sum(dur_us).cast("double") / n / 1000000
    return headers.agg(F.sum(sent).cast("bigint").alias("total_sent"), mean_s.alias("mean_seconds"),
                       (F.sum(sent) / mean_s).alias("offered_rps"), n.alias("n_workers"))
