"""Serving queries: events as requests against the current decision tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import adapters as ad
from ..functions import parsing as P
from ..functions.rules import rules_case
from ..operators import aggregates as agg
from ..operators import policies
from ..operators import serving as S
from ..operators.ordinal import with_ordinal
from .decisions import last_epoch, state, updates
from .registry import query
from .sqlparts import GAMMA, PICKS, SCORE_SUM, TOTALS, UPDATES, state_sql, ucb_schedule_sql

EPS = 0.1
N_ENDPOINTS = 4
TYPES_SQL = "['click','error','purchase','signup','view']"

REQ_SQL = f"""req AS (SELECT event_id, CAST(user_id % 8 AS VARCHAR) AS group_id, event_type,
                   list_filter({TYPES_SQL}, lambda x: x <> event_type) AS offered FROM events)"""


def requests(spark, d) -> DataFrame:
    """Request table: payload -> features (E2) -> group (feature 4) and offered options."""
    r = ad.request_payloads(ad.table(spark, d, "events")).withColumn("features", P.split_features("payload"))
    return r.select("event_id", "features", F.get("features", 4).alias("group_id"),
                    P.candidates("features").alias("offered"))


def current_schedules(spark, d) -> DataFrame:
    """The decision table now: each group's UCB schedule at the last epoch."""
    upd = updates(spark, d)
    last = last_epoch(upd)
    st = state(spark, d)
    return policies.ucb_schedule(st.where(F.col("epoch") == last), PICKS, GAMMA).select("group_id", "schedule")


CUR_SQL = f"""{UPDATES}, {TOTALS}, {state_sql()}, {ucb_schedule_sql()},
cur AS (SELECT group_id, schedule FROM sched WHERE epoch = (SELECT max(epoch) FROM updates))"""


@query("serve_schedule", f"""WITH RECURSIVE {CUR_SQL}, {REQ_SQL},
j AS (SELECT r.*, string_split(trim(c.schedule, ': '), ':') AS arr FROM req r LEFT JOIN cur c USING (group_id)),
k AS (SELECT *, arr[(event_id % len(arr)) + 1] AS pick FROM j),
m AS (SELECT *, coalesce(pick IS NOT NULL AND pick <> '' AND list_contains(offered, pick), false) AS ok FROM k)
SELECT event_id, group_id, CASE WHEN ok THEN pick ELSE offered[((event_id // 7) % len(offered)) + 1] END AS decision,
       ok AS from_schedule FROM m""")
def serve_schedule_q(spark, d):
    r = S.lookup(requests(spark, d), current_schedules(spark, d))
    p = S.schedule_pick("schedule", "offered", F.col("event_id"), F.floor(F.col("event_id") / 7))
    return r.select("event_id", "group_id", p["decision"].alias("decision"), p["from_schedule"].alias("from_schedule"))


# The schedule made from an epoch is in force from that epoch's end on.
SINCE_SQL = f"{ad.EPOCH_BASE_US} + (epoch + 1) * {ad.EPOCH_WIDTH_US}"


@query("serve_as_of", f"""WITH RECURSIVE {UPDATES}, {TOTALS}, {state_sql()}, {ucb_schedule_sql()}, {REQ_SQL},
chg AS (SELECT group_id, epoch, schedule, {SINCE_SQL} AS since_us FROM sched),
rt AS (SELECT r.*, u.ts_us FROM req r JOIN updates u USING (event_id)),
j AS (SELECT rt.event_id, rt.group_id, rt.offered, c.epoch, string_split(trim(c.schedule, ': '), ':') AS arr
      FROM rt ASOF LEFT JOIN chg c ON rt.group_id = c.group_id AND rt.ts_us >= c.since_us),
k AS (SELECT *, arr[(event_id % len(arr)) + 1] AS pick FROM j),
m AS (SELECT *, coalesce(pick IS NOT NULL AND pick <> '' AND list_contains(offered, pick), false) AS ok FROM k)
SELECT event_id, group_id, coalesce(epoch, -1) AS epoch, CASE WHEN ok THEN pick ELSE offered[((event_id // 7) % len(offered)) + 1] END AS decision,
       ok AS from_schedule FROM m""")
def serve_as_of_q(spark, d):
    changes = policies.ucb_schedule(state(spark, d), PICKS, GAMMA).select(
        "group_id", "epoch", "schedule", ((F.col("epoch") + 1) * ad.EPOCH_WIDTH_US + ad.EPOCH_BASE_US).alias("since_us"))
    asked = requests(spark, d).withColumn("ts_us", F.get("features", 1).cast("bigint")).drop("features")
    r = S.lookup_as_of(asked, changes, ["epoch", "schedule"])
    p = S.schedule_pick("schedule", "offered", F.col("event_id"), F.floor(F.col("event_id") / 7))
    return r.select("event_id", "group_id", F.coalesce("epoch", F.lit(-1)).alias("epoch"), p["decision"].alias("decision"), p["from_schedule"].alias("from_schedule"))


def eg_table(spark, d) -> DataFrame:
    return policies.best_arm(agg.arm_totals(updates(spark, d)))


EG_SQL = f"""{UPDATES},
t AS (SELECT group_id, decision, {SCORE_SUM} / count(*) AS mean_score FROM updates GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY mean_score DESC, decision) AS rn FROM t),
eg AS (SELECT group_id, max(CASE WHEN rn = 1 THEN decision END) AS best,
              coalesce(array_agg(decision ORDER BY decision) FILTER (WHERE rn > 1), []) AS others
       FROM rk GROUP BY group_id)"""


def _eps_sql(op: str) -> str:
    return f"""WITH {EG_SQL}, {REQ_SQL},
j AS (SELECT r.event_id, r.group_id, eg.best, eg.others, r.event_id % 101 AS u, r.event_id // 101 AS u2
      FROM req r LEFT JOIN eg USING (group_id)),
x AS (SELECT *, (u {op} CAST({EPS} AS DECIMAL(12,6)) * 100) AND len(others) > 0 AS explored FROM j)
SELECT event_id, group_id, CASE WHEN explored THEN others[(u2 % len(others)) + 1] ELSE best END AS decision, explored FROM x"""


def _serve_eps(spark, d, mode):
    r = S.lookup(requests(spark, d), eg_table(spark, d))
    eps = F.lit(EPS).cast("decimal(12,6)")
    p = S.epsilon_pick("best", "others", eps, F.col("event_id") % 101, F.floor(F.col("event_id") / 101), explore_when=mode)
    return r.select("event_id", "group_id", p["decision"].alias("decision"), p["explored"].alias("explored"))


@query("serve_eps_gt", _eps_sql(">"))
def serve_eps_gt_q(spark, d):
    return _serve_eps(spark, d, "gt")


@query("serve_eps_lt", _eps_sql("<"))
def serve_eps_lt_q(spark, d):
    return _serve_eps(spark, d, "lt")


def weights(spark, d) -> DataFrame:
    """``name;weight`` table per group: each option's share of the group's reports, in basis
    points (integer floor), so cumulative sums are exact."""
    t = agg.arm_totals(updates(spark, d))
    tot = t.groupBy("group_id").agg(F.sum("cnt").alias("_tot"))
    return (t.join(tot, "group_id")
            .select("group_id", F.col("decision").alias("ord"), F.col("decision").alias("name"),
                    (F.floor(F.col("cnt") * 10000 / F.col("_tot")).cast("decimal(10,0)") / 10000)
                    .cast("decimal(10,4)").alias("weight")))


@query("serve_weighted", f"""WITH {UPDATES},
t AS (SELECT group_id, decision AS name, count(*) AS cnt FROM updates GROUP BY ALL),
w AS (SELECT group_id, name, (cnt * 10000) // sum(cnt) OVER (PARTITION BY group_id) AS bp FROM t),
c AS (SELECT group_id, name, sum(bp) OVER (PARTITION BY group_id ORDER BY name ROWS UNBOUNDED PRECEDING) AS cum_bp,
             row_number() OVER (PARTITION BY group_id ORDER BY name DESC) AS rdesc FROM w),
r AS (SELECT event_id, CAST(user_id % 8 AS VARCHAR) AS group_id, event_id % 101 AS u FROM events),
h AS (SELECT r.event_id, r.group_id, min(c.name) FILTER (WHERE c.cum_bp >= r.u * 100) AS first_hit,
             max(CASE WHEN c.rdesc = 1 THEN c.name END) AS last_name
      FROM r JOIN c USING (group_id) GROUP BY r.event_id, r.group_id)
SELECT event_id, group_id, coalesce(first_hit, last_name) AS decision FROM h""")
def serve_weighted_q(spark, d):
    table = S.weight_table(weights(spark, d))
    r = S.lookup(requests(spark, d), table)
    return r.select("event_id", "group_id", S.weighted_pick("cum_weights", F.col("event_id") % 101).alias("decision"))


BUYERS_RULE = [([(3, "purchase")], "buyers")]  # fixed value: one rule, feature 3 == purchase -> group "buyers"


@query("serve_default", f"""WITH RECURSIVE {CUR_SQL},
r AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'buyers' ELSE CAST(user_id % 8 AS VARCHAR) END AS group_id FROM events)
SELECT event_id, group_id, coalesce(schedule, 'Oops') AS decision FROM r LEFT JOIN cur USING (group_id)""")
def serve_default_q(spark, d):
    r = requests(spark, d)
    r = r.withColumn("group_id", P.default_group(rules_case(F.col("features"), BUYERS_RULE), "features", "asn"))
    j = S.lookup(r, current_schedules(spark, d))
    return j.select("event_id", "group_id", F.coalesce("schedule", F.lit("Oops")).alias("decision"))


@query("round_robin", f"""SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS ord,
       (row_number() OVER (ORDER BY event_id) - 1) % {N_ENDPOINTS} AS endpoint FROM events""")
def round_robin_q(spark, d):
    e = with_ordinal(ad.table(spark, d, "events").select("event_id"), ["event_id"])
    return e.select("event_id", "ord", S.round_robin("ord", N_ENDPOINTS).alias("endpoint"))
