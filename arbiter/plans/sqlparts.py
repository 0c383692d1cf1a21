"""Shared oracle SQL fragments (DuckDB dialect), mirroring the adapters and operators."""

from __future__ import annotations

GAMMA = 0.5          # exactly representable: the decayed state is bit-identical across engines
PICKS = 5            # schedule length P
RESET_PERIOD = 15    # epochs per reset segment
ORIGIN = "b1:9092"   # origin tag written into decision messages
EPSILON = 0.1
WARM_RPS = 2         # warm start loads RPS * 60 copies of a historic update

UPDATES = """updates AS (
  SELECT event_id, ts, epoch_us(ts) AS ts_us,
         CAST(user_id % 8 AS VARCHAR) AS group_id, event_type AS decision, value AS cost,
         (epoch_us(ts) - 1704067200000000) // 21600000000 AS epoch
  FROM events)"""

SCORE_SUM = "CAST(-sum(CAST(cost AS DECIMAL(18,2))) AS DOUBLE)"

TOTALS = """totals AS (
  SELECT group_id, decision, CAST(-sum(CAST(cost AS DECIMAL(18,9))) AS DOUBLE) AS xs, CAST(count(*) AS DOUBLE) AS xc, epoch
  FROM updates GROUP BY group_id, decision, epoch)"""


def state_sql(reset: int | None = None, gamma: float = GAMMA) -> str:
    """Recursive CTE ``state(group_id, decision, [segment,] epoch, score_sum, cnt)``: same
    operation order as the Spark fold (x + gamma * prev)."""
    seg = f"epoch // {reset}" if reset else "0"
    end = f"least(lastE.e1, (segment + 1) * {reset} - 1)" if reset else "lastE.e1"
    return f"""lastE AS (SELECT max(epoch) AS e1 FROM updates),
t2 AS (SELECT *, {seg} AS segment FROM totals),
firsts AS (SELECT group_id, decision, segment, min(epoch) AS e0 FROM t2 GROUP BY ALL),
rec(group_id, decision, segment, epoch, s, c) AS (
  SELECT f.group_id, f.decision, f.segment, f.e0, t2.xs, t2.xc
  FROM firsts f JOIN t2 ON t2.group_id = f.group_id AND t2.decision = f.decision AND t2.epoch = f.e0
  UNION ALL
  SELECT r.group_id, r.decision, r.segment, r.epoch + 1,
         CASE WHEN t2.xs IS NULL THEN r.s * {gamma} ELSE t2.xs + r.s * {gamma} END,
         CASE WHEN t2.xc IS NULL THEN r.c * {gamma} ELSE t2.xc + r.c * {gamma} END
  FROM rec r CROSS JOIN lastE
  LEFT JOIN t2 ON t2.group_id = r.group_id AND t2.decision = r.decision AND t2.epoch = r.epoch + 1
  WHERE r.epoch + 1 <= {end.replace('segment', 'r.segment')}),
state AS (SELECT group_id, decision, segment, epoch, s AS score_sum, c AS cnt FROM rec)"""


def ucb_schedule_sql(src: str = "state", picks: int = PICKS, gamma: float = GAMMA) -> str:
    """Unrolled P-step discounted-UCB schedule over ``src(group_id, epoch, decision, score_sum, cnt)``.
    Produces CTE ``sched(group_id, epoch, n_eff, schedule)``."""
    parts = [f"""a0 AS (
  SELECT group_id, epoch, decision,
         CASE WHEN cnt > 0 THEN score_sum / cnt ELSE 0.0 END AS mean, cnt,
         CAST(sum(floor(cnt)) OVER (PARTITION BY group_id, epoch) AS BIGINT) AS n
  FROM {src})"""]
    for k in range(1, picks + 1):
        parts.append(f"""p{k} AS (
  SELECT group_id, epoch, decision AS best FROM (
    SELECT group_id, epoch, decision, row_number() OVER (
      PARTITION BY group_id, epoch ORDER BY
        CASE WHEN cnt > 0 THEN mean + (CASE WHEN n > 1 THEN 1000.0 * sqrt(2.0 * ln(CAST(n AS DOUBLE))) ELSE 0.0 END) / sqrt(cnt)
             ELSE 0.0 END DESC, decision) AS rn
    FROM a{k-1}) WHERE rn = 1)""")
        if k < picks:
            parts.append(f"""a{k} AS (
  SELECT a.group_id, a.epoch, a.decision, a.mean,
         (CASE WHEN a.decision = p.best THEN a.cnt + 1 ELSE a.cnt END) * {gamma} AS cnt, a.n + 1 AS n
  FROM a{k-1} a JOIN p{k} p ON a.group_id = p.group_id AND a.epoch = p.epoch)""")
    joins = " ".join(f"JOIN p{k} USING (group_id, epoch)" for k in range(1, picks + 1))
    sched = " || ".join(f"p{k}.best || ':'" for k in range(1, picks + 1))
    parts.append(f"""n0 AS (SELECT DISTINCT group_id, epoch, n AS n_eff FROM a0),
sched AS (SELECT group_id, epoch, n_eff, {sched} AS schedule FROM n0 {joins})""")
    return ",\n".join(parts)
