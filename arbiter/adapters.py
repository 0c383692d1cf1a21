"""Adapters from the supplied Parquet tables to the record shapes the operators consume.

The reference reads quality reports, requests, traces and load-test outcomes from topics and
files; here those records are derived from the supplied tables so that every query's work grows
with them. Every adapter is a projection (no shuffle) unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed adapter parameters (mirrored in the oracle SQL).
EPOCH_BASE_US = 1704067200000000      # 2024-01-01 00:00:00 UTC, first day of `events`
EPOCH_WIDTH_US = 21600000000          # 6 h per epoch -> 120 epochs over the 30 days of events
N_USER_GROUPS = 8                     # group_id = user_id % 8
TAB = "\t"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_micros(col: str | Column) -> Column:
    """Epoch micros of a zone-less timestamp read as UTC wall clock."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


#: Costs are summed as decimals of this scale; their size stays below COST_LIMIT.
COST_SCALE = 9
COST_LIMIT = 1e9


def exact(col: str | Column) -> Column:
    """A cost as DECIMAL(18, COST_SCALE): sums then don't depend on their order. Ratios and other costs far
    below a cent keep their digits; values of COST_LIMIT and more are refused where messages are parsed."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(f"decimal(18,{COST_SCALE})")


def updates(events: DataFrame, epoch_width_us: int = EPOCH_WIDTH_US) -> DataFrame:
    """events -> quality updates ``(event_id, ts, ts_us, group_id, decision, cost, epoch)``.

    One event is one session report: the arm is the event type and the observed cost its value.
    """
    us = ts_micros("ts")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        us.alias("ts_us"),
        (F.col("user_id") % N_USER_GROUPS).cast("string").alias("group_id"),
        F.col("event_type").alias("decision"),
        F.col("value").alias("cost"),
        F.floor((us - F.lit(EPOCH_BASE_US)) / F.lit(epoch_width_us)).cast("bigint").alias("epoch"),
    )


def update_messages(events: DataFrame) -> DataFrame:
    """events -> routed update messages as JSON text (the `internal_groups` topic value).

    An error event reports no cost, so its update carries the option name only; such messages
    are rejected by the parser.
    """
    upd = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.concat(F.col("event_type"), F.lit(TAB), F.col("value").cast("decimal(18,2)").cast("string")))
    group = (F.col("user_id") % N_USER_GROUPS).cast("string")
    value = F.concat(F.lit('{"update":"'), F.regexp_replace(upd, TAB, "\\\\t"),
                     F.lit('","group_id":"'), group, F.lit('"}'))
    return events.select("event_id", value.alias("value"))


def request_payloads(events: DataFrame) -> DataFrame:
    """events -> request payloads: 15 TAB-separated features, then the offered options.

    Offered options: every event type except the request's own one (so a scheduled pick is
    sometimes not offered and the fallback path runs).
    """
    feats = [F.col("event_id").cast("string"), ts_micros("ts").cast("string"),
             F.col("user_id").cast("string"), F.col("event_type"),
             (F.col("user_id") % N_USER_GROUPS).cast("string")]
    feats += [F.lit("")] * (15 - len(feats))
    offered = F.array_remove(F.array(*[F.lit(t) for t in event_types(events)]), F.col("event_type"))
    payload = F.concat_ws(TAB, *feats, F.array_join(offered, TAB))
    return events.select("event_id", payload.alias("payload"))


# The five event types of the supplied `events` table, in name order.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def event_types(events: DataFrame) -> tuple[str, ...]:
    """EVENT_TYPES and whatever other types ``events`` holds, in name order. An event without a type is an error."""
    found = {r[0] for r in events.select("event_type").distinct().collect()}
    if None in found:
        raise ValueError("events without an event_type")
    return tuple(sorted(found.union(EVENT_TYPES)))


# ---- customers as session payloads (routing / grouping queries) ------------------------------

# Positional labels of the customer payload (the reference's label config, for our data).
CUSTOMER_LABELS = ("custkey", "name", "segment", "nation", "asn", "region", "acctbal")


def customer_payloads(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """customer ⋈ nation ⋈ region -> ``(c_custkey, n_name, r_name, c_mktsegment, payload)``.

    The dimensions (nation, region) are tiny; Catalyst broadcasts them, the customer side is
    never shuffled.
    """
    from .operators.joins import small
    nr = small(nation.join(small(region), nation.n_regionkey == region.r_regionkey)
               .select("n_nationkey", "n_name", "r_name"))
    c = customer.join(nr, customer.c_nationkey == nr.n_nationkey, "left")
    payload = F.concat_ws(TAB, F.col("c_custkey").cast("string"), "c_name", "c_mktsegment",
                          F.coalesce("n_name", F.lit("")), F.col("c_nationkey").cast("string"),
                          F.coalesce("r_name", F.lit("")), F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
    return c.select("c_custkey", "n_name", "r_name", "c_mktsegment", "c_acctbal", payload.alias("payload"))


# ---- orders + lineitem as a replay trace ---------------------------------------------------------

# Fixed values of the synthetic load curves: thresholds of the two steps.
LOAD_THRESHOLDS = ("0.25", "0.50")


def trace_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders ⋈ lineitem (pre-aggregated per order and return flag) -> trace text lines.

    ``ts⇥orderkey⇥custkey⇥status⇥priority⇥(10 empty)⇥DecisionMap<flag>,<qty>⇥...⇥LoadMap<flag>,0.25;<f1>;0.50;<f2>⇥...``
    Decision = return flag, its cost = the order's quantity under that flag; load curve factors
    from the flag's max tax and max discount. Output ``(line_no, line)``; line_no = order key.
    lineitem is combined per (order, flag) map-side before the shuffle, then joined on order key.
    """
    li = (lineitem.groupBy("l_orderkey", "l_returnflag")
          .agg(F.sum(exact("l_quantity")).alias("qty"), F.max("l_tax").alias("mtax"), F.max("l_discount").alias("mdisc")))
    f1 = (F.lit(1) + F.col("mtax").cast("decimal(10,2)")).cast("string")
    f2 = (F.lit(1) + F.lit(10) * F.col("mdisc").cast("decimal(10,2)")).cast("string")
    item = F.struct(F.col("l_returnflag").alias("k"),
                    F.concat_ws(",", "l_returnflag", F.col("qty").cast("string")).alias("d"),
                    F.concat(F.col("l_returnflag"), F.lit(","), F.lit(LOAD_THRESHOLDS[0]), F.lit(";"), f1, F.lit(";"),
                             F.lit(LOAD_THRESHOLDS[1]), F.lit(";"), f2).alias("l"))
    per_order = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                      (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")).alias("ts_ms"))
    j = o.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    feats = [F.col("ts_ms").cast("string"), F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
             F.col("o_orderstatus"), F.col("o_orderpriority")] + [F.lit("")] * 10
    line = F.concat(F.concat_ws(TAB, *feats), F.lit(TAB), F.lit("DecisionMap"),
                    F.array_join(F.transform("items", lambda x: x["d"]), TAB), F.lit(TAB), F.lit("LoadMap"),
                    F.array_join(F.transform("items", lambda x: x["l"]), TAB))
    return j.select(F.col("o_orderkey").alias("line_no"), line.alias("line"))
