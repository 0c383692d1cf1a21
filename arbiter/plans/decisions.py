"""Decision path queries: parse -> aggregate -> discount -> policy -> message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as ad
from ..functions.parsing import decision_message, parse_updates
from ..operators import aggregates as agg
from ..operators import discount, policies
from ..sources.seeds import warm_start_rows
from .registry import query
from .sqlparts import (EPSILON, GAMMA, ORIGIN, PICKS, RESET_PERIOD, SCORE_SUM, TOTALS, UPDATES,
                       WARM_RPS, state_sql, ucb_schedule_sql)


def updates(spark: SparkSession, d: str) -> DataFrame:
    return ad.updates(ad.table(spark, d, "events"))


def last_epoch(upd: DataFrame) -> int:
    """The stream's last epoch: one scalar (a max over one pruned column); -1 without updates."""
    last = upd.agg(F.max("epoch")).first()[0]
    return -1 if last is None else int(last)


# ---- parsing -------------------------------------------------------------------------------

MSGS_SQL = r"""msgs AS (
  SELECT event_id,
         '{"update":"' || replace(CASE WHEN event_type = 'error' THEN event_type
                                  ELSE event_type || chr(9) || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END,
                                  chr(9), '\t')
         || '","group_id":"' || CAST(user_id % 8 AS VARCHAR) || '"}' AS value
  FROM events),
p AS (
  SELECT event_id, value,
         json_valid(trim(value)) AND json_type(trim(value)) = 'OBJECT' AS ok,
         json_extract_string(trim(value), '$.update') AS upd,
         json_extract_string(trim(value), '$.group_id') AS gid
  FROM msgs),
q AS (
  SELECT *, string_split(upd, chr(9)) AS parts, TRY_CAST(string_split(upd, chr(9))[2] AS DOUBLE) AS cost,
         CASE WHEN NOT ok THEN 'not_json' WHEN gid IS NULL THEN 'missing_group'
              WHEN upd IS NULL THEN 'missing_update' WHEN len(string_split(upd, chr(9))) < 2 THEN 'missing_cost'
              WHEN TRY_CAST(string_split(upd, chr(9))[2] AS DOUBLE) IS NULL THEN 'bad_cost' END AS reason
  FROM p)"""


def _parsed(spark, d):
    return parse_updates(ad.update_messages(ad.table(spark, d, "events")), keep=("event_id",))


@query("parse_updates", f"""WITH {MSGS_SQL}
SELECT event_id, gid AS group_id, parts[1] AS decision, -cost AS score, CAST(1.0 AS DOUBLE) AS cnt FROM q WHERE reason IS NULL""")
def parse_updates_q(spark, d):
    return _parsed(spark, d)[0]


@query("parse_rejects", f"""WITH {MSGS_SQL}
SELECT event_id, value, reason FROM q WHERE reason IS NOT NULL""")
def parse_rejects_q(spark, d):
    return _parsed(spark, d)[1]


# ---- plain aggregates ------------------------------------------------------------------------

@query("arm_totals", f"""WITH {UPDATES}
SELECT group_id, decision, {SCORE_SUM} AS score_sum, count(*) AS cnt,
       CASE WHEN count(*) > 0 THEN {SCORE_SUM} / count(*) ELSE 0.0 END AS mean_score
FROM updates GROUP BY group_id, decision""")
def arm_totals_q(spark, d):
    return agg.arm_totals(updates(spark, d))


@query("arm_totals_per_epoch", f"""WITH {UPDATES}
SELECT group_id, decision, epoch, {SCORE_SUM} AS score_sum, count(*) AS cnt,
       CASE WHEN count(*) > 0 THEN {SCORE_SUM} / count(*) ELSE 0.0 END AS mean_score
FROM updates GROUP BY group_id, decision, epoch""")
def arm_totals_per_epoch_q(spark, d):
    return agg.arm_totals(updates(spark, d), keys=("group_id", "decision", "epoch"))


# Sliding windows: 6 h long, 1 h slide (the reference's 60 s / 2 s, scaled to the data's span).
WINDOW, SLIDE = "6 hours", "1 hour"
_SLIDE_S, _WIN_S = 3600, 21600
SLIDING_ROWS = f"""slid AS (
  SELECT u.*, (epoch_us(ts) // {_SLIDE_S * 1000000}) * {_SLIDE_S} - k * {_SLIDE_S} AS window_start
  FROM updates u, (SELECT unnest(range(0, {_WIN_S // _SLIDE_S})) AS k))"""


@query("sliding_arm_totals", f"""WITH {UPDATES}, {SLIDING_ROWS}
SELECT window_start, window_start + {_WIN_S} AS window_end, group_id, decision,
       {SCORE_SUM} AS score_sum, count(*) AS cnt
FROM slid GROUP BY window_start, group_id, decision""")
def sliding_arm_totals_q(spark, d):
    return agg.sliding_arm_totals(updates(spark, d), WINDOW, SLIDE)


@query("warm_start_window", f"""WITH {UPDATES},
seeds AS (SELECT group_id, arg_min(decision, event_id) AS decision, arg_min(cost, event_id) AS cost,
                 arg_min(ts, event_id) AS ts, {WARM_RPS * 60} AS w FROM updates GROUP BY group_id),
rows_ AS (SELECT group_id, decision, cost, ts, w FROM seeds
          UNION ALL SELECT group_id, decision, cost, ts, 1 AS w FROM updates),
slid AS (SELECT r.*, (epoch_us(ts) // {_SLIDE_S * 1000000}) * {_SLIDE_S} - k * {_SLIDE_S} AS window_start
         FROM rows_ r, (SELECT unnest(range(0, {_WIN_S // _SLIDE_S})) AS k))
SELECT window_start, window_start + {_WIN_S} AS window_end, group_id, decision,
       CAST(-sum(CAST(cost AS DECIMAL(18,2)) * w) AS DOUBLE) AS score_sum, CAST(sum(w) AS BIGINT) AS cnt
FROM slid GROUP BY window_start, group_id, decision""")
def warm_start_window_q(spark, d):
    upd = updates(spark, d)
    seeded = warm_start_rows(upd, WARM_RPS * 60)
    return agg.sliding_arm_totals(seeded, WINDOW, SLIDE, weight="weight")


# ---- costs far below a cent: 5 decimals, as ratios have them ------------------------------------

RATIO_SQL = """updates AS (
  SELECT event_id, ts, CAST(user_id % 8 AS VARCHAR) AS group_id, event_type AS decision, event_id % 997 AS n,
         (epoch_us(ts) - 1704067200000000) // 21600000000 AS epoch FROM events)"""
RATIO_SUM = "CAST(-sum(n) AS DOUBLE) / 100000"


def ratios(spark, d) -> DataFrame:
    return updates(spark, d).withColumn("cost", (F.col("event_id") % 997).cast("double") / 100000)


@query("arm_totals_ratio", f"""WITH {RATIO_SQL}
SELECT group_id, decision, {RATIO_SUM} AS score_sum, count(*) AS cnt, {RATIO_SUM} / count(*) AS mean_score
FROM updates GROUP BY group_id, decision""")
def arm_totals_ratio_q(spark, d):
    return agg.arm_totals(ratios(spark, d))


@query("best_arm_ratio", f"""WITH {RATIO_SQL},
t AS (SELECT group_id, decision, {RATIO_SUM} / count(*) AS mean_score FROM updates GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY mean_score DESC, decision) AS rn FROM t)
SELECT group_id, decision AS best FROM r WHERE rn = 1""")
def best_arm_ratio_q(spark, d):
    return policies.best_arm(agg.arm_totals(ratios(spark, d))).select("group_id", "best")


@query("sliding_ratio", f"""WITH {RATIO_SQL}, {SLIDING_ROWS}
SELECT window_start, window_start + {_WIN_S} AS window_end, group_id, decision, {RATIO_SUM} AS score_sum, count(*) AS cnt
FROM slid GROUP BY window_start, group_id, decision""")
def sliding_ratio_q(spark, d):
    return agg.sliding_arm_totals(ratios(spark, d), WINDOW, SLIDE)


@query("discounted_ratio", f"""WITH RECURSIVE {RATIO_SQL},
totals AS (SELECT group_id, decision, {RATIO_SUM} AS xs, CAST(count(*) AS DOUBLE) AS xc, epoch
           FROM updates GROUP BY group_id, decision, epoch), {state_sql()}
SELECT group_id, decision, epoch, score_sum, cnt FROM state""")
def discounted_ratio_q(spark, d):
    upd = ratios(spark, d)
    return discount.discounted_state(discount.per_epoch_totals(upd), GAMMA, last_epoch(upd))


# ---- greedy / epsilon-greedy -------------------------------------------------------------------

@query("best_arm", f"""WITH {UPDATES},
t AS (SELECT group_id, decision, {SCORE_SUM} / count(*) AS mean_score FROM updates GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY mean_score DESC, decision) AS rn FROM t)
SELECT group_id, max(CASE WHEN rn = 1 THEN decision END) AS best,
       coalesce(string_agg(CASE WHEN rn > 1 THEN decision END, ',' ORDER BY decision), '') AS others,
       count(*) AS n_arms
FROM r GROUP BY group_id""")
def best_arm_q(spark, d):
    b = policies.best_arm(agg.arm_totals(updates(spark, d)))
    return b.select("group_id", "best", F.array_join("others", ",").alias("others"),
                    (F.size("others") + 1).cast("bigint").alias("n_arms"))


@query("epsilon_greedy_message", f"""WITH {UPDATES}, {SLIDING_ROWS},
t AS (SELECT window_start, group_id, decision, {SCORE_SUM} / count(*) AS mean_score FROM slid GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start, group_id ORDER BY mean_score DESC, decision) AS rn FROM t),
b AS (SELECT window_start, group_id, max(CASE WHEN rn = 1 THEN decision END) AS best,
             coalesce(string_agg(CASE WHEN rn > 1 THEN '"' || decision || '"' END, ',' ORDER BY decision), '') AS others
      FROM r GROUP BY window_start, group_id)
SELECT window_start, group_id, best,
       group_id || ';{{"random":[' || others || '],"best":"' || best || '","epsilon":{EPSILON}}};From: {ORIGIN}' AS message
FROM b""")
def epsilon_greedy_message_q(spark, d):
    w = agg.sliding_arm_totals(updates(spark, d), WINDOW, SLIDE)
    w = w.withColumn("mean_score", F.col("score_sum") / F.col("cnt"))
    b = policies.best_arm(w, keys=("window_start", "group_id"))
    return b.select("window_start", "group_id", "best",
                    policies.eg_message(b, EPSILON, ORIGIN).alias("message"))


# ---- discounted state and UCB ------------------------------------------------------------------

def state(spark, d, reset: int | None = None) -> DataFrame:
    upd = updates(spark, d)
    return discount.discounted_state(discount.per_epoch_totals(upd), GAMMA, last_epoch(upd),
                                     reset_period=reset)


@query("discounted_state", f"""WITH RECURSIVE {UPDATES}, {TOTALS}, {state_sql()}
SELECT group_id, decision, epoch, score_sum, cnt FROM state""")
def discounted_state_q(spark, d):
    return state(spark, d)


@query("discounted_state_reset", f"""WITH RECURSIVE {UPDATES}, {TOTALS}, {state_sql(RESET_PERIOD)}
SELECT group_id, decision, segment, epoch, score_sum, cnt FROM state""")
def discounted_state_reset_q(spark, d):
    return state(spark, d, RESET_PERIOD)


@query("effective_n", f"""WITH RECURSIVE {UPDATES}, {TOTALS}, {state_sql()}
SELECT group_id, epoch, CAST(sum(floor(cnt)) AS BIGINT) AS n_eff, count(*) AS n_arms FROM state GROUP BY ALL""")
def effective_n_q(spark, d):
    return agg.effective_n(state(spark, d))


@query("ucb_scores", f"""WITH RECURSIVE {UPDATES}, {TOTALS}, {state_sql()},
s AS (SELECT *, CASE WHEN cnt > 0 THEN score_sum / cnt ELSE 0.0 END AS mean_score,
             CAST(sum(floor(cnt)) OVER (PARTITION BY group_id, epoch) AS BIGINT) AS n_eff FROM state),
u AS (SELECT *, CASE WHEN cnt > 0 THEN mean_score + (CASE WHEN n_eff > 1 THEN 1000.0 * sqrt(2.0 * ln(CAST(n_eff AS DOUBLE))) ELSE 0.0 END) / sqrt(cnt)
                     ELSE 0.0 END AS ucb FROM s)
SELECT group_id, epoch, decision, mean_score, cnt, n_eff, CAST(ucb AS FLOAT) AS ucb,
       row_number() OVER (PARTITION BY group_id, epoch ORDER BY ucb DESC, decision) AS rank
FROM u""")
def ucb_scores_q(spark, d):
    # The score is reported in single precision: ``ln`` may differ in the last bit between
    # engines; ranks are computed at full precision before the cast.
    s = policies.ucb_scores(state(spark, d))
    return s.select("group_id", "epoch", "decision", "mean_score", "cnt", "n_eff",
                    F.col("ucb").cast("float").alias("ucb"), F.col("rank").cast("bigint").alias("rank"))


@query("ucb_schedule", f"""WITH RECURSIVE {UPDATES}, {TOTALS}, {state_sql()}, {ucb_schedule_sql()}
SELECT group_id, epoch, n_eff, schedule, group_id || ';' || schedule || ';From: {ORIGIN}' AS message FROM sched""")
def ucb_schedule_q(spark, d):
    s = policies.ucb_schedule(state(spark, d), PICKS, GAMMA)
    return s.withColumn("message", decision_message(F.col("group_id"), F.col("schedule"), ORIGIN))


@query("ucb_reset_schedule", f"""WITH RECURSIVE {UPDATES}, {TOTALS}, {state_sql(RESET_PERIOD)}, {ucb_schedule_sql()},
x AS (SELECT group_id, epoch, CASE WHEN (epoch + 1) % {RESET_PERIOD} = 0 THEN 'random' ELSE schedule END AS payload FROM sched)
SELECT group_id, epoch, payload, group_id || ';' || payload || ';From: {ORIGIN}' AS message FROM x""")
def ucb_reset_schedule_q(spark, d):
    s = policies.ucb_schedule(state(spark, d, RESET_PERIOD), PICKS, GAMMA)
    s = s.select("group_id", "epoch",
                 policies.reset_payload(F.col("schedule"), F.col("epoch"), RESET_PERIOD).alias("payload"))
    return s.withColumn("message", decision_message(F.col("group_id"), F.col("payload"), ORIGIN))
