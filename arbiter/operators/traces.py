"""Offline policy evaluation over traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import exact
from ..functions.parsing import minute_offset, offered, parse_trace_line, second_offset
from .joins import small
from .ordinal import with_ordinal


def parse_trace(lines: DataFrame, line: str = "line", keep=("line_no",)) -> DataFrame:
    """S8 + E9: trace text -> records ``(ts_ms, features, decision_map, load_map)``."""
    p = parse_trace_line(line)
    return lines.select(*keep, *[c.alias(k) for k, c in p.items()])


def with_offsets(records: DataFrame, start_ms: int) -> DataFrame:
    """Second and minute offsets from the trace start."""
    return (records.withColumn("sec", second_offset("ts_ms", F.lit(int(start_ms))))
            .withColumn("minute", minute_offset("sec")))


def trace_start(records_or_lines: DataFrame, ts: Column) -> int:
    """Trace start = the earliest record (one scalar); 0 without records."""
    return int(records_or_lines.agg(F.min(ts)).first()[0] or 0)


def chosen_cost(records: DataFrame, chosen: str = "chosen") -> DataFrame:
    """J9 + E17: the chosen decision's cost by map lookup; ``offered`` tells if it was on offer."""
    return (records.withColumn("offered", F.coalesce(offered("decision_map", chosen), F.lit(False)))
            .withColumn("cost", F.try_element_at("decision_map", F.col(chosen))))


def load_share(records: DataFrame, decision: str = "chosen", minute: str = "minute", order=("ts_ms", "line_no"),
               ok: str = "offered") -> DataFrame:
    """W1 + A16 + A17: running count of this decision in the minute / sessions in the minute.

    Only sessions whose decision is on offer count as load; the minute's total is over all sessions. A session whose
    decision isn't on offer has no load (null). The running count is a distributed per-(minute, decision) ordinal
    of the keys alone (a hot minute is split by range partitioning); minute totals are a grouped count joined back.
    """
    keys = list(dict.fromkeys([minute, decision, *order]))
    run = with_ordinal(records.where(F.col(ok)).select(*keys), list(order), partition_by=[minute, decision], name="_run")
    tot = records.groupBy(minute).agg(F.count(F.lit(1)).alias("minute_total"))
    r = records.join(small(tot), minute).join(run, keys, "left")
    return (r.withColumn("running", F.col("_run") + 1).drop("_run")
            .withColumn("load", F.col("running") / F.col("minute_total")))


def step_factor(curve: str | Column, load: str | Column) -> Column:
    """Factor at the largest threshold strictly below the load, else 1."""
    c = F.col(curve) if isinstance(curve, str) else curve
    x = F.col(load) if isinstance(load, str) else load
    below = F.filter(c, lambda p: p["threshold"] < x)
    return F.coalesce(F.array_max(below)["factor"], F.lit(1.0))


def per_second(records: DataFrame, sec: str = "sec", ok: str = "offered", cost: str = "cost", by=()) -> DataFrame:
    """A14 + A15 + A26: sessions sent, succeeded and mean cost (over successes) per second (and ``by``)."""
    return (records.groupBy(*by, sec)
            .agg(F.count(F.lit(1)).alias("n_sent"), F.count_if(F.col(ok)).alias("n_ok"),
                 F.sum(F.when(F.col(ok), exact(cost))).alias("_s"))
            .withColumn("mean_cost", F.when(F.col("n_ok") > 0, F.col("_s").cast("double") / F.col("n_ok")))
            .drop("_s"))


def failover(rows: DataFrame, bucket: str, status: str, cost: str = "cost") -> DataFrame:
    """Per bucket, mean cost of all rows and split by status (``all`` rows plus one row per status). The rows bring
    their cost; ``failover_local`` takes it from the decision map."""
    by_status = rows.groupBy(bucket, status).agg(F.sum(exact(cost)).alias("_s"), F.count(F.lit(1)).alias("n"))
    both = by_status.select(bucket, F.explode(F.array(F.col(status), F.lit("all"))).alias(status), "_s", "n")
    out = both.groupBy(bucket, status).agg(F.sum("_s").alias("_s"), F.sum("n").alias("n"))
    return out.withColumn("mean_cost", F.col("_s").cast("double") / F.col("n")).drop("_s")


def failover_local(records: DataFrame, sec: str = "sec", failed: str = "failed", chosen: str = "chosen") -> DataFrame:
    """A failed request takes the third decision of its own map, in the order written, and that decision's cost;
    the others take ``chosen`` and don't count when it isn't on offer.

    Per second and status (``online``, ``local`` and ``all``): ``n`` requests that count, ``n_cost`` of them with a
    cost, and the mean over those. A failed request with fewer than three decisions counts without a cost.
    """
    gone = F.coalesce(F.col(failed), F.lit(False))
    decision = F.when(gone, F.get(F.map_keys("decision_map"), 2)).otherwise(F.col(chosen))
    rows = (records.where(gone | F.coalesce(offered("decision_map", chosen), F.lit(False)))
            .select(F.col(sec), F.when(gone, "local").otherwise("online").alias("status"),
                    exact(F.try_element_at("decision_map", decision)).alias("cost")))
    by_status = rows.groupBy(sec, "status").agg(F.sum("cost").alias("_s"), F.count(F.lit(1)).alias("n"),
                                                F.count("cost").alias("n_cost"))
    both = by_status.select(sec, F.explode(F.array("status", F.lit("all"))).alias("status"), "_s", "n", "n_cost")
    out = both.groupBy(sec, "status").agg(F.sum("_s").alias("_s"), F.sum("n").alias("n"), F.sum("n_cost").alias("n_cost"))
    return out.withColumn("mean_cost", F.when(F.col("n_cost") > 0, F.col("_s").cast("double") / F.col("n_cost"))).drop("_s")
