"""Exponentially discounted state across epochs.

Recurrence per (group, decision): ``S_B = x_B + gamma * S_{B-1}`` for the score sum and the
count; epochs are dense (an idle arm keeps decaying every epoch) and groups never expire.

Batch form: the per-epoch totals of one arm (at most one row per epoch, so the list is bounded
by the number of epochs, not by the data volume) are folded in epoch order by a higher-order
``aggregate`` -- Catalyst-only, the same operation order as the streaming form, so
results are bit-identical to a sequential recurrence. Hot groups are harmless: the raw rows are
combined map-side into per-epoch totals before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import exact

STATE_T = "struct<s:double,c:double>"
BLOCK = 64  # epochs whose states are gathered in one array


def per_epoch_totals(updates: DataFrame, keys=("group_id", "decision"), epoch: str = "epoch") -> DataFrame:
    """A1 per epoch: exact score sum and count per (keys, epoch)."""
    return (updates.groupBy(*keys, epoch)
            .agg((-F.sum(exact("cost"))).cast("double").alias("xs"),
                 F.count(F.lit(1)).cast("double").alias("xc")))


def _step(gamma: float):
    """One epoch of the recurrence: previous state and the epoch's totals (either may be null) -> state."""
    g = F.lit(float(gamma))

    def step(prev: Column, x: Column) -> Column:
        s = F.when(x.isNull(), prev["s"] * g).when(prev.isNull(), x["xs"]).otherwise(x["xs"] + prev["s"] * g)
        c = F.when(x.isNull(), prev["c"] * g).when(prev.isNull(), x["xc"]).otherwise(x["xc"] + prev["c"] * g)
        return F.struct(s.alias("s"), c.alias("c"))
    return step


def discounted_state(totals: DataFrame, gamma: float, last_epoch: int,
                     reset_period: int | None = None, keys=("group_id", "decision")) -> DataFrame:
    """A3 (and A4 when ``reset_period`` is set): dense decayed state per (keys, epoch).

    ``totals``: ``(keys, epoch, xs, xc)`` from :func:`per_epoch_totals`.
    ``last_epoch``: the last epoch of the stream; every arm is emitted up to it.
    ``reset_period``: epochs ``k*period .. k*period+period-1`` form one segment; the state starts
    empty at each segment start (A4), and an arm is emitted only from its first epoch with data
    in the segment up to the segment end.
    Output: ``keys, epoch, score_sum, cnt``.

    A first fold over an arm's epochs keeps only the state before each block of BLOCK epochs; the
    blocks then become rows and are folded on their own, so arrays that grow stay short.
    """
    part = list(keys)
    t = totals
    if reset_period:
        t = t.withColumn("segment", F.floor(F.col("epoch") / reset_period).cast("bigint"))
        part.append("segment")
    arms = t.groupBy(*part).agg(F.array_sort(F.collect_list(F.struct("epoch", "xs", "xc"))).alias("_x"))
    end = F.lit(int(last_epoch)).cast("bigint")
    if reset_period:
        end = F.least(end, (F.col("segment") + 1) * reset_period - 1)
    none = F.lit(None).cast("struct<xs:double,xc:double>")
    # one entry per epoch, null where the arm has no data
    arms = arms.select(*part, F.get("_x", 0)["epoch"].alias("_e0"), F.flatten(F.transform("_x", lambda x, i: F.concat(
        F.array(F.struct(x["xs"].alias("xs"), x["xc"].alias("xc"))),
        F.array_repeat(none, (F.coalesce(F.get("_x", i + 1)["epoch"], end + 1) - x["epoch"] - 1).cast("int"))))).alias("_dense"))
    step, empty = _step(gamma), F.lit(None).cast(STATE_T)
    start = F.struct(F.lit(0).alias("n"), empty.alias("now"), F.array().cast(f"array<{STATE_T}>").alias("before"))
    carried = F.aggregate("_dense", start, lambda acc, x: F.struct(
        (acc["n"] + 1).alias("n"), step(acc["now"], x).alias("now"),
        F.when(acc["n"] % BLOCK == 0, F.concat(acc["before"], F.array(acc["now"]))).otherwise(acc["before"]).alias("before")))["before"]
    blocks = (arms.withColumn("_before", carried)
              .select(*part, "_e0", "_dense", F.posexplode("_before").alias("_b", "_carry"))
              .select(*part, (F.col("_e0") + F.col("_b") * BLOCK).alias("_e0"), "_carry",
                      F.slice("_dense", F.col("_b") * BLOCK + 1, F.lit(BLOCK)).alias("_xs")))
    states = F.aggregate("_xs", F.array().cast(f"array<{STATE_T}>"), lambda acc, x: F.concat(acc, F.array(
        step(F.coalesce(F.get(acc, F.size(acc) - 1), F.col("_carry")), x))))
    out = blocks.select(*part, "_e0", F.posexplode(states).alias("_i", "_st"))
    shown = [*keys, "segment"] if reset_period else list(keys)
    return out.select(*shown, (F.col("_e0") + F.col("_i")).cast("bigint").alias("epoch"),
                      F.col("_st.s").alias("score_sum"), F.col("_st.c").alias("cnt"))


def merge_state(history: DataFrame, batch: DataFrame, gamma: float, keys=("group_id", "decision")) -> DataFrame:
    """One epoch of the recurrence as a full outer join of the decayed history and the new
    batch totals (``xs``, ``xc``). Used by the streaming form with a versioned state table."""
    g = F.lit(float(gamma))
    h = history.select(*keys, (F.col("s") * g).alias("hs"), (F.col("c") * g).alias("hc"))
    j = h.join(batch, list(keys), "full_outer")
    return j.select(
        *keys,
        F.when(F.col("xs").isNull(), F.col("hs")).when(F.col("hs").isNull(), F.col("xs"))
         .otherwise(F.col("xs") + F.col("hs")).alias("s"),
        F.when(F.col("xc").isNull(), F.col("hc")).when(F.col("hc").isNull(), F.col("xc"))
         .otherwise(F.col("xc") + F.col("hc")).alias("c"))
