"""Series, blocks and latency reports.

Global order comes from :mod:`ordinal` (bucketed ranks, never a single-partition window);
rolling frames use bounded look-back blocks. Costs are summed as exact decimals and integer
microseconds, so results do not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import exact
from .ordinal import lag_global, with_lookback, with_ordinal


def block_means(df: DataFrame, ord_col: str, value: str, block: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """Mean of each full block of ``block`` rows, labelled by its last 1-based ordinal."""
    b = (df.groupBy(*partition_by, F.floor(F.col(ord_col) / block).alias("_blk"))
         .agg(F.sum(exact(value)).alias("_s"), F.count(F.lit(1)).alias("_n"))
         .where(F.col("_n") == block))
    return b.select(*partition_by, ((F.col("_blk") + 1) * block).cast("bigint").alias("label"),
                    (F.col("_s").cast("double") / F.col("_n")).alias("mean_value"))


def rolling_mean(df: DataFrame, ord_col: str, value: str, rows: int, block: int = 65536) -> DataFrame:
    """Mean over the last ``rows`` rows (fewer at the start), in global ordinal order."""
    t = with_lookback(df, ord_col, rows - 1, block)
    w = Window.partitionBy("_blk").orderBy(ord_col).rowsBetween(-(rows - 1), 0)
    return (t.withColumn("rolling_mean", F.sum(exact(value)).over(w).cast("double") / F.count(F.lit(1)).over(w))
            .where(~F.col("_carry")).drop("_blk", "_carry"))


def zip_series(a: DataFrame, b: DataFrame, on: str = "label", value: str = "mean_value") -> DataFrame:
    """Pair two series by ordinal; the result is as long as the shorter one."""
    return a.select(on, F.col(value).alias("a")).join(b.select(on, F.col(value).alias("b")), on)


def length_gap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Lengths of both series and their difference."""
    both = a.select(F.lit("a").alias("_s")).unionByName(b.select(F.lit("b").alias("_s")))
    return (both.agg(F.count_if(F.col("_s") == "a").alias("n_a"), F.count_if(F.col("_s") == "b").alias("n_b"))
            .withColumn("gap", F.abs(F.col("n_a") - F.col("n_b"))))


def pivot_policies(long: DataFrame, index: Sequence[str], policy: str, value: str, policies: Sequence[str]) -> DataFrame:
    """One column per policy (values listed up front: no extra pass to find them)."""
    return long.groupBy(*index).pivot(policy, list(policies)).agg(F.first(value))


def gaps(df: DataFrame, ord_col: str, ts_us: str, name: str = "gap") -> DataFrame:
    """Inter-arrival gap in seconds (null for the first record)."""
    g = lag_global(df, ord_col, ts_us, "_prev")
    return g.withColumn(name, (F.col(ts_us) - F.col("_prev")).cast("double") / 1000000).drop("_prev")


def ack_blocks(df: DataFrame, ord_col: str, ts_us: str, n: int) -> DataFrame:
    """Time to acknowledge each full block of ``n`` messages, and the running total.

    The first block is timed from its first message (the stream start, rows being in time order)."""
    b = (df.groupBy(F.floor(F.col(ord_col) / n).alias("blk"))
         .agg(F.max(ts_us).alias("_last"), F.min(ts_us).alias("_start"), F.count(F.lit(1)).alias("_n")))
    b = lag_global(b, "blk", "_last", "_prev").where(F.col("_n") == n)
    return b.select(((F.col("blk") + 1) * n).cast("bigint").alias("total_acked"),
                    ((F.col("_last") - F.coalesce("_prev", "_start")).cast("double") / 1000000).alias("secs"))


def second_index(t_us: str, start_us: int):
    """A18 bucket: ``max(0, ceil((t - start) / 1 s) - 1)`` in integer microseconds."""
    return F.greatest(F.lit(0), F.floor((F.col(t_us) - F.lit(start_us) + 999999) / 1000000) - 1).cast("bigint")


def dense_seconds(per: DataFrame, sec: str = "sec", horizon: int = 86_400, start: int = 0) -> DataFrame:
    """``per`` (one row per occupied second) with the silent seconds in between and from ``start`` on.

    Adds ``seconds``, the number of seconds that a row stands for. An occupied second is 1 long and keeps its columns; in
    silent rows they are null. A silence of at most ``horizon`` seconds gives a row per second; a longer one is one row that
    bears its first second and its length, so that nothing is lost and a far outlier costs one row. No spine is walked: each
    occupied second brings the silence before it, an array of at most ``horizon``. Rows without a second are left out.
    """
    rest = [c for c in per.columns if c != sec]
    own = F.col(sec).cast("bigint")
    known = with_ordinal(per.where(F.col(sec).isNotNull()), [sec], name="_ord")
    o = lag_global(known, "_ord", own, "_prev")
    first = F.coalesce(F.col("_prev") + 1, F.least(F.lit(start).cast("bigint"), own))
    row = lambda s, n: F.struct(s.alias("_sec"), n.cast("bigint").alias("seconds"))
    here = F.array(row(own, F.lit(1)))
    rows = (F.when(own == first, here).when(own - first > horizon, F.concat(F.array(row(first, own - first)), here))
            .otherwise(F.transform(F.sequence(first, own), lambda s: row(s, F.lit(1)))))
    spread = o.select(own.alias("_own"), *rest, F.inline(rows))
    return spread.select(F.col("_sec").alias(sec), "seconds", *[F.when(F.col("_sec") == F.col("_own"), F.col(c)).alias(c) for c in rest])


def latency_series(outcomes: DataFrame, t_us: str, rt_us: str, start_us: int, horizon: int = 86_400) -> DataFrame:
    """Mean response time (s) and count per second from 0 to the last occupied one.

    ``seconds`` is 1, or the length of a silence of over ``horizon`` seconds (see :func:`dense_seconds`).
    Outcomes without a time are left out."""
    per = (outcomes.where(F.col(t_us).isNotNull()).groupBy(second_index(t_us, start_us).alias("sec"))
           .agg(F.sum(rt_us).alias("_s"), F.count(F.lit(1)).alias("n")))
    return dense_seconds(per, "sec", horizon).select(
        "sec", F.coalesce(F.col("_s").cast("double") / F.col("n") / 1000000, F.lit(0.0)).alias("mean_rt"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "seconds")


def cdf(df: DataFrame, value: str, tiebreak: str) -> DataFrame:
    """Empirical CDF, ``pct = rank * 100 / n`` with zero-based ranks in value order."""
    n = df.count()
    o = with_ordinal(df.select(value, tiebreak), [value, tiebreak], name="_r")
    return o.select(value, (F.col("_r") * 100 / F.lit(n)).alias("pct"))


def nth_smallest(df: DataFrame, value: str, nth: int, low: int, high: int, ways: int = 1024) -> int:
    """The value of 0-based rank ``nth`` of a whole-number column whose values lie in ``low .. high``.

    Exact selection by counting: each pass counts the rows per one of ``ways`` equal ranges (combined map-side, at most ``ways``
    rows come back) and goes on with the range that holds the rank: seven passes for any 64-bit column, no sort.
    """
    while low < high:
        width = -(-(high - low + 1) // ways)
        away = F.col(value).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        part = (away - F.pmod(away, F.lit(width).cast("decimal(20,0)"))) / F.lit(width).cast("decimal(20,0)")
        counts = dict(map(tuple, df.where(F.col(value).between(low, high)).groupBy(part.cast("int")).count().collect()))
        at = 0
        for at in sorted(counts):
            if nth < counts[at]:
                break
            nth -= counts[at]
        low, high = low + at * width, min(high, low + (at + 1) * width - 1)
    return low


def percentile_at(df: DataFrame, value: str, q_num: int, q_den: int) -> DataFrame:
    """Exact ``sorted[(q_num * n) div q_den]`` of a whole-number column (p90: 9/10), one row (n, p); none without values.

    Nulls don't count. Ties need no order, as equal values are the same result.
    """
    kind = df.schema[value].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{value} is {kind}: scale it to whole numbers first")
    spark, wide = df.sparkSession, df.select(F.col(value).cast("bigint").alias("v")).where("v is not null")
    n, low, high = wide.agg(F.count("v"), F.min("v"), F.max("v")).first()
    found = [(n, nth_smallest(wide, "v", q_num * n // q_den, low, high))] if n and q_num * n // q_den < n else []
    return spark.createDataFrame(found, "n bigint, p bigint")


def percentile_sketch(df: DataFrame, value: str, q: float, accuracy: int = 10_000) -> DataFrame:
    """A20 from one pass over a mergeable sketch: within n / ``accuracy`` ranks of the exact one; any numeric column."""
    return df.agg(F.count(value).alias("n"), F.percentile_approx(value, q, accuracy).alias("p"))
