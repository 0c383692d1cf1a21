"""Trace replay queries: orders ⋈ lineitem as a trace, evaluated under a greedy policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import adapters as ad
from ..operators import aggregates as agg
from ..operators import policies
from ..operators import traces as T
from ..operators.joins import counted_small
from ..operators.ordinal import with_ordinal
from ..operators.series import dense_seconds
from ..session import materialize
from .registry import query


def lines(spark, d) -> DataFrame:
    return ad.trace_lines(ad.table(spark, d, "orders"), ad.table(spark, d, "lineitem"))


def records(spark, d) -> DataFrame:
    """Parsed trace records, materialized once: the start scalar, the policy aggregate, the
    ordinal's sample and the main job all read the same copy."""
    r = T.parse_trace(lines(spark, d)).select("line_no", "ts_ms", F.get("features", 3).alias("order_status"),
                                              F.get("features", 4).alias("group_id"), "decision_map", "load_map")
    r = materialize(r)
    return T.with_offsets(r, T.trace_start(r, F.col("ts_ms")))


def policy(recs: DataFrame) -> DataFrame:
    """Greedy decision table over the trace: per group, the option with the lowest mean cost."""
    arms = recs.select("group_id", F.explode("decision_map").alias("decision", "cost"))
    return policies.best_arm(agg.arm_totals(arms)).select("group_id", F.col("best").alias("chosen"))


def served(recs: DataFrame) -> DataFrame:
    """``recs`` with what the greedy policy chooses; a record whose group has no policy stays, with nothing chosen."""
    return T.chosen_cost(recs.join(counted_small(policy(recs)), "group_id", "left"))


def chosen(spark, d) -> DataFrame:
    return served(records(spark, d))


def with_load(spark, d) -> DataFrame:
    """Only the chosen decision's curve travels through the load's shuffles, not the maps."""
    c = chosen(spark, d).withColumn("curve", F.try_element_at("load_map", F.col("chosen"))).select(
        "line_no", "ts_ms", "sec", "minute", "chosen", "offered", "cost", "curve")
    return T.load_share(c).withColumn("factor", T.step_factor("curve", "load"))


REC_SQL = """li AS (SELECT l_orderkey, l_returnflag AS decision, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
              1 + CAST(max(l_tax) AS DECIMAL(10,2)) AS f1, 1 + 10 * CAST(max(l_discount) AS DECIMAL(10,2)) AS f2
       FROM lineitem GROUP BY ALL),
rec0 AS (SELECT o_orderkey AS line_no, epoch_ms(o_orderdate) + o_orderkey AS ts_ms, o_orderpriority AS group_id,
                li.decision, CAST(li.qty AS DOUBLE) AS cost, li.f1, li.f2
         FROM orders JOIN li ON o_orderkey = l_orderkey),
st AS (SELECT min(ts_ms) AS s FROM rec0),
rec AS (SELECT rec0.*, (ts_ms // 1000) - (st.s // 1000) AS sec, ((ts_ms // 1000) - (st.s // 1000)) // 60 AS minute FROM rec0, st),
pol AS (SELECT group_id, decision AS chosen FROM (
          SELECT group_id, decision, row_number() OVER (PARTITION BY group_id
                 ORDER BY CAST(-sum(CAST(cost AS DECIMAL(18,2))) AS DOUBLE) / count(*) DESC, decision) AS rn
          FROM rec GROUP BY group_id, decision) WHERE rn = 1),
lns AS (SELECT DISTINCT line_no, ts_ms, sec, minute, group_id FROM rec),
cc AS (SELECT l.*, p.chosen, r.cost, r.cost IS NOT NULL AS offered, r.f1, r.f2
       FROM lns l LEFT JOIN pol p USING (group_id) LEFT JOIN rec r ON r.line_no = l.line_no AND r.decision = p.chosen),
ls AS (SELECT *, CASE WHEN offered THEN count(*) FILTER (WHERE offered)
                OVER (PARTITION BY minute, chosen ORDER BY ts_ms, line_no ROWS UNBOUNDED PRECEDING) END AS running,
              count(*) OVER (PARTITION BY minute) AS minute_total FROM cc),
lf AS (SELECT *, running / minute_total AS load,
              CASE WHEN NOT offered THEN 1.0 WHEN running / minute_total > 0.5 THEN CAST(f2 AS DOUBLE)
                   WHEN running / minute_total > 0.25 THEN CAST(f1 AS DOUBLE) ELSE 1.0 END AS factor FROM ls)"""


@query("parse_trace", f"""WITH {REC_SQL}
SELECT line_no, ts_ms, sec, minute, group_id, decision, cost,
       '0.25:' || CAST(f1 AS VARCHAR) || '|0.50:' || CAST(f2 AS VARCHAR) AS curve FROM rec""")
def parse_trace_q(spark, d):
    r = records(spark, d)
    e = r.select("line_no", "ts_ms", "sec", "minute", "group_id", "load_map",
                 F.explode("decision_map").alias("decision", "cost"))
    fmt = lambda x: x.cast("decimal(10,2)").cast("string")
    curve = F.array_join(F.transform(F.try_element_at("load_map", F.col("decision")),
                                     lambda p: F.concat(fmt(p["threshold"]), F.lit(":"), fmt(p["factor"]))), "|")
    return e.select("line_no", "ts_ms", "sec", "minute", "group_id", "decision", "cost", curve.alias("curve"))


@query("sort_trace", """SELECT row_number() OVER (ORDER BY CAST(epoch_ms(o_orderdate) + o_orderkey AS VARCHAR), o_orderkey) - 1 AS rank,
       CAST(epoch_ms(o_orderdate) + o_orderkey AS VARCHAR) AS first_field, o_orderkey AS line_no
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def sort_trace_q(spark, d):
    ln = lines(spark, d).withColumn("first_field", F.split("line", "\t", 2).getItem(0))
    s = with_ordinal(ln.select("first_field", "line_no"), ["first_field", "line_no"], name="rank")
    return s.select("rank", "first_field", "line_no")


@query("chosen_cost", f"""WITH {REC_SQL}
SELECT line_no, group_id, chosen, offered, cost FROM cc""")
def chosen_cost_q(spark, d):
    return chosen(spark, d).select("line_no", "group_id", "chosen", "offered", "cost")


@query("evaluate_policy", f"""WITH {REC_SQL}
SELECT sec, count(*) AS n_sent, count(*) FILTER (WHERE offered) AS n_ok,
       CASE WHEN count(*) FILTER (WHERE offered) > 0 THEN
         CAST(sum(CASE WHEN offered THEN CAST(cost AS DECIMAL(18,2)) * CAST(factor AS DECIMAL(10,2)) END) AS DOUBLE)
         / count(*) FILTER (WHERE offered) END AS mean_cost
FROM lf GROUP BY sec""")
def evaluate_policy_q(spark, d):
    c = with_load(spark, d)
    c = c.withColumn("cost", F.when(F.col("offered"), ad.exact("cost") * F.col("factor").cast("decimal(10,2)")))
    out = c.groupBy("sec").agg(F.count(F.lit(1)).alias("n_sent"), F.count_if("offered").alias("n_ok"),
                               F.sum("cost").alias("_s"))
    return out.select("sec", "n_sent", "n_ok",
                      F.when(F.col("n_ok") > 0, F.col("_s").cast("double") / F.col("n_ok")).alias("mean_cost"))


@query("per_second_counts", f"""WITH {REC_SQL}
SELECT sec, count(*) AS n_sent, count(*) FILTER (WHERE offered) AS n_ok FROM cc GROUP BY sec""")
def per_second_counts_q(spark, d):
    return T.per_second(chosen(spark, d)).select("sec", "n_sent", "n_ok")


# Fixed value: silences up to this many seconds are given second by second; the trace pauses for most of every day.
HORIZON = 3_600


@query("per_second_dense", f"""WITH {REC_SQL},
p AS (SELECT sec, count(*) AS n_sent, count(*) FILTER (WHERE offered) AS n_ok FROM cc GROUP BY sec),
g AS (SELECT sec, lag(sec) OVER (ORDER BY sec) AS prev FROM p),
z AS (SELECT prev + 1 AS first, sec - prev - 1 AS len FROM g WHERE sec > prev + 1)
SELECT sec, CAST(1 AS BIGINT) AS seconds, n_sent, n_ok FROM p
UNION ALL SELECT first, len, 0, 0 FROM z WHERE len > {HORIZON}
UNION ALL SELECT unnest(range(first, first + len)), 1, 0, 0 FROM z WHERE len <= {HORIZON}""")
def per_second_dense_q(spark, d):
    per = T.per_second(chosen(spark, d)).select("sec", "n_sent", "n_ok")
    return dense_seconds(per, "sec", HORIZON).select("sec", "seconds", *[
        F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_sent", "n_ok")])


@query("per_second_cost", f"""WITH {REC_SQL}
SELECT sec, CAST(sum(CAST(cost AS DECIMAL(18,2))) FILTER (WHERE offered) AS DOUBLE) / count(*) FILTER (WHERE offered) AS mean_cost
FROM cc GROUP BY sec HAVING count(*) FILTER (WHERE offered) > 0""")
def per_second_cost_q(spark, d):
    return T.per_second(chosen(spark, d)).where(F.col("n_ok") > 0).select("sec", "mean_cost")


@query("sessions_per_minute", f"""WITH {REC_SQL}
SELECT minute, count(*) AS n_sessions FROM lns GROUP BY minute""")
def sessions_per_minute_q(spark, d):
    return records(spark, d).groupBy("minute").agg(F.count(F.lit(1)).alias("n_sessions"))


@query("sessions_per_minute_decision", f"""WITH {REC_SQL}
SELECT minute, chosen AS decision, count(*) AS n_sessions FROM cc WHERE offered GROUP BY minute, chosen""")
def sessions_per_minute_decision_q(spark, d):
    return chosen(spark, d).where("offered").groupBy("minute", F.col("chosen").alias("decision")).agg(F.count(F.lit(1)).alias("n_sessions"))


@query("load_share", f"""WITH {REC_SQL}
SELECT line_no, minute, chosen AS decision, coalesce(running, 0) AS running, minute_total, load FROM lf""")
def load_share_q(spark, d):
    c = T.load_share(chosen(spark, d).select("line_no", "ts_ms", "minute", "chosen", "offered"))
    return c.select("line_no", "minute", F.col("chosen").alias("decision"), F.coalesce("running", F.lit(0)).alias("running"),
                    "minute_total", "load")


@query("load_factor", f"""WITH {REC_SQL}
SELECT line_no, chosen AS decision, load, factor FROM lf""")
def load_factor_q(spark, d):
    return with_load(spark, d).select("line_no", F.col("chosen").alias("decision"), "load", "factor")


@query("failover_cost", """WITH r AS (
  SELECT (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) // 3600000000 AS bucket,
         CASE WHEN event_type = 'error' THEN 'local' ELSE 'online' END AS status, value AS cost FROM events),
a AS (SELECT bucket, status, sum(CAST(cost AS DECIMAL(18,2))) AS s, count(*) AS n FROM r GROUP BY ALL
      UNION ALL SELECT bucket, 'all', sum(CAST(cost AS DECIMAL(18,2))), count(*) FROM r GROUP BY bucket)
SELECT bucket, status, n, CAST(s AS DOUBLE) / n AS mean_cost FROM a""")
def failover_cost_q(spark, d):
    e = ad.table(spark, d, "events")
    us = ad.ts_micros("ts")
    start = int(e.agg(F.min(us)).first()[0] or 0)
    rows = e.select(F.floor((us - F.lit(start)) / 3600000000).cast("bigint").alias("bucket"),
                    F.when(F.col("event_type") == "error", "local").otherwise("online").alias("status"),
                    F.col("value").alias("cost"))
    return T.failover(rows, "bucket", "status").select("bucket", "status", "n", "mean_cost")


# Fixed value: orders of this status stand for the requests that failed.
FAILED_STATUS = "F"


@query("failover_local", f"""WITH {REC_SQL},
k AS (SELECT line_no, cost, row_number() OVER (PARTITION BY line_no ORDER BY decision) AS nth FROM rec),
f AS (SELECT cc.sec, o.o_orderstatus = '{FAILED_STATUS}' AS failed, cc.offered, cc.cost, k.cost AS local_cost
      FROM cc JOIN orders o ON o.o_orderkey = cc.line_no LEFT JOIN k ON k.line_no = cc.line_no AND k.nth = 3),
r AS (SELECT sec, CASE WHEN failed THEN 'local' ELSE 'online' END AS status,
             CAST(CASE WHEN failed THEN local_cost ELSE cost END AS DECIMAL(18,2)) AS cost FROM f WHERE failed OR offered),
a AS (SELECT sec, status, sum(cost) AS s, count(*) AS n, count(cost) AS n_cost FROM r GROUP BY ALL
      UNION ALL SELECT sec, 'all', sum(cost), count(*), count(cost) FROM r GROUP BY sec)
SELECT sec, status, n, n_cost, CASE WHEN n_cost > 0 THEN CAST(s AS DOUBLE) / n_cost END AS mean_cost FROM a""")
def failover_local_q(spark, d):
    c = chosen(spark, d).withColumn("failed", F.col("order_status") == FAILED_STATUS)
    return T.failover_local(c).select("sec", "status", "n", "n_cost", "mean_cost")
