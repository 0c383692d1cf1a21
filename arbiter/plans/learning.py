"""Learning policies over the trace, served epoch by epoch, and their series side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import adapters as ad
from ..operators import learning as L
from ..operators import series as S
from ..operators import traces as T
from ..operators.ordinal import with_ordinal
from ..session import materialize
from .registry import query
from .sqlparts import EPSILON, GAMMA, PICKS
from .traces import REC_SQL, records, served

EPOCH_S = 2_592_000   # 30 days of the trace per epoch (2 s in the reference)
WINDOW_EPOCHS = 12    # sliding window of the epsilon-greedy totals
RESET_EPOCHS = 15
BLOCK = 60            # seconds with a value per block of a series

POLICIES: dict[str, L.Policy] = {
    "ucb": L.Ucb(PICKS, GAMMA),
    "ucb_reset": L.Ucb(PICKS, GAMMA, RESET_EPOCHS),
    "eps": L.EpsilonGreedy(EPSILON, WINDOW_EPOCHS),
    "weighted": L.Weighted(GAMMA),
}

REQ_SQL = f"""{REC_SQL},
req AS (SELECT line_no, group_id, sec, sec // {EPOCH_S} AS epoch, list(decision ORDER BY decision) AS keys
        FROM rec GROUP BY line_no, group_id, sec),
rq AS (SELECT *, keys[((line_no // 7) % len(keys)) + 1] AS fb FROM req),
arms AS (SELECT DISTINCT decision AS d FROM rec UNION ALL SELECT NULL),
span AS (SELECT group_id, min(epoch) AS e0, max(epoch) AS e1 FROM req GROUP BY group_id)"""


def _slots_sql(src: str, p: str, name: str) -> str:
    """CTEs that end in ``{p}slots(group_id, epoch, u, d)``: the decision of every slot under the state ``src``, null without one."""
    policy, parts = POLICIES[name], []
    if name.startswith("ucb"):
        parts.append(f"""{p}a0 AS (SELECT group_id, epoch, decision, CASE WHEN c > 0 THEN s / c ELSE 0.0 END AS mean, c AS cnt,
               CAST(sum(floor(c)) OVER (PARTITION BY group_id, epoch) AS BIGINT) AS n FROM {src} WHERE decision IS NOT NULL)""")
        for k in range(1, PICKS + 1):
            done = "".join(f", f{j}" for j in range(1, k))
            parts.append(f"""{p}r{k} AS (SELECT *, row_number() OVER (PARTITION BY group_id, epoch ORDER BY
                CASE WHEN cnt > 0 THEN mean + (CASE WHEN n > 1 THEN 1000.0 * sqrt(2.0 * ln(CAST(n AS DOUBLE))) ELSE 0.0 END) / sqrt(cnt)
                ELSE 0.0 END DESC, decision) AS rn FROM {p}a{k - 1}),
              {p}a{k} AS (SELECT group_id, epoch, decision, mean, (CASE WHEN rn = 1 THEN cnt + 1 ELSE cnt END) * {GAMMA} AS cnt,
                n + 1 AS n{done}, rn = 1 AS f{k} FROM {p}r{k})""")
        flags = " ".join(f"WHEN {k - 1} THEN f{k}" for k in range(1, PICKS + 1))
        parts.append(f"""{p}hit AS (SELECT group_id, epoch, u, decision AS d FROM {p}a{PICKS},
               (SELECT unnest(range(0, {PICKS})) AS u) WHERE CASE u {flags} END)""")
    elif name == "eps":
        parts.append(f"""{p}t AS (SELECT group_id, epoch, decision, sum(s) AS s, sum(c) AS c FROM {src} WHERE decision IS NOT NULL GROUP BY ALL),
              {p}b AS (SELECT *, row_number() OVER (PARTITION BY group_id, epoch ORDER BY CASE WHEN c > 0 THEN s / c ELSE 0.0 END DESC, decision) = 1 AS best,
                count(*) OVER (PARTITION BY group_id, epoch) - 1 AS m FROM {p}t),
              {p}o AS (SELECT *, row_number() OVER (PARTITION BY group_id, epoch, best ORDER BY decision) - 1 AS nth FROM {p}b),
              {p}hit AS (SELECT group_id, epoch, u, decision AS d FROM {p}o, (SELECT unnest(range(0, {policy.n_slots})) AS u)
                WHERE CASE WHEN u < {EPSILON * 100} AND m > 0 THEN NOT best AND nth = u % m ELSE best END)""")
    else:
        parts.append(f"""{p}i AS (SELECT group_id, epoch, decision, c / greatest(-s, 1e-9) AS x FROM {src} WHERE decision IS NOT NULL),
              {p}w AS (SELECT *, floor(10000 * x / sum(x) OVER (PARTITION BY group_id, epoch)) AS bp FROM {p}i),
              {p}c AS (SELECT *, sum(bp) OVER (PARTITION BY group_id, epoch ORDER BY decision ROWS UNBOUNDED PRECEDING) AS cum FROM {p}w),
              {p}hit AS (SELECT group_id, epoch, u, coalesce(min(decision) FILTER (WHERE cum >= 100 * u), max(decision)) AS d
                FROM {p}c, (SELECT unnest(range(0, {policy.n_slots})) AS u) GROUP BY group_id, epoch, u)""")
    parts.append(f"""{p}slots AS (SELECT g.group_id, g.epoch, n.u, h.d FROM (SELECT group_id, epoch FROM {src} WHERE decision IS NULL) g
              CROSS JOIN (SELECT unnest(range(0, {policy.n_slots})) AS u) n
              LEFT JOIN {p}hit h ON h.group_id = g.group_id AND h.epoch = g.epoch AND h.u = n.u)""")
    return ",\n".join(parts)


def _learn_sql(name: str) -> str:
    """CTEs that end in ``{name}_served``: the trace served by the policy. A row without a decision carries a group that knows nothing."""
    policy, p = POLICIES[name], f"{name}_"
    if name == "eps":
        keep = f"SELECT group_id, epoch + 1, decision, born, s, c FROM {p}st WHERE decision IS NOT NULL AND born >= epoch - {WINDOW_EPOCHS - 1}"
    else:
        keep = f"SELECT group_id, epoch + 1, decision, 0, s * {GAMMA}, c * {GAMMA} FROM {p}st WHERE decision IS NOT NULL"
    born = "x.epoch" if name == "eps" else "0"
    last = f"AND epoch % {RESET_EPOCHS} <> 0" if name == "ucb_reset" else ""
    return f"""{p}f AS (
  SELECT rq.group_id, rq.epoch, rq.line_no % {policy.n_slots} AS u, arms.d,
         CASE WHEN arms.d IS NOT NULL AND list_contains(keys, arms.d) THEN arms.d ELSE fb END AS a,
         sum(CAST(rec.cost AS DECIMAL(18,9))) AS x, count(*) AS n
  FROM rq CROSS JOIN arms JOIN rec ON rec.line_no = rq.line_no
    AND rec.decision = CASE WHEN arms.d IS NOT NULL AND list_contains(keys, arms.d) THEN arms.d ELSE fb END GROUP BY ALL),
{p}st(group_id, epoch, decision, born, s, c) AS (
  SELECT group_id, e0, CAST(NULL AS VARCHAR), CAST(0 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM span
  UNION ALL (
  WITH {_slots_sql(f"{p}st", f"{p}in_", name)},
  x AS (SELECT t.group_id, t.epoch, f.a, sum(f.x) AS x, sum(f.n) AS n FROM {p}in_slots t JOIN {p}f f
        ON f.group_id = t.group_id AND f.epoch = t.epoch AND f.u = t.u AND f.d IS NOT DISTINCT FROM t.d GROUP BY ALL),
  nxt(group_id, epoch, decision, born, s, c) AS (
    SELECT x.group_id, x.epoch + 1, x.a, {born}, CAST(-x.x AS DOUBLE), CAST(x.n AS DOUBLE) FROM x UNION ALL {keep})
  SELECT nxt.group_id, epoch, decision, CAST(born AS BIGINT), sum(s), sum(c) FROM nxt JOIN span USING (group_id)
  WHERE epoch <= e1 {last} GROUP BY ALL
  UNION ALL SELECT group_id, epoch + 1, NULL, 0, 0, 0 FROM {p}st JOIN span USING (group_id) WHERE decision IS NULL AND epoch < e1)),
{_slots_sql(f"{p}st", f"{p}out_", name)},
{p}served AS (
  SELECT rq.line_no, rq.group_id, rq.sec, coalesce(list_contains(keys, t.d), false) AS from_policy, rec.cost
  FROM rq JOIN {p}out_slots t ON t.group_id = rq.group_id AND t.epoch = rq.epoch AND t.u = rq.line_no % {policy.n_slots}
  JOIN rec ON rec.line_no = rq.line_no AND rec.decision = CASE WHEN coalesce(list_contains(keys, t.d), false) THEN t.d ELSE fb END)"""


def trace(spark, d) -> DataFrame:
    return records(spark, d).withColumn("epoch", F.floor(F.col("sec") / EPOCH_S))


def per_second(served: DataFrame) -> DataFrame:
    """A15 per group: requests, those served by the policy itself, mean cost of the choices; seconds without a choice are left out."""
    return (served.where("chosen is not null").groupBy("group_id", "sec")
            .agg(F.count(F.lit(1)).alias("n_sent"), F.count_if("from_policy").alias("n_policy"), F.sum(ad.exact("cost")).alias("_s"))
            .select("group_id", "sec", "n_sent", "n_policy", (F.col("_s").cast("double") / F.col("n_sent")).alias("mean_cost")))


def _evaluate(name: str):
    @query(f"evaluate_{name}", f"""WITH RECURSIVE {REQ_SQL},
{_learn_sql(name)}
SELECT group_id, sec, count(*) AS n_sent, count(*) FILTER (WHERE from_policy) AS n_policy,
       CAST(sum(CAST(cost AS DECIMAL(18,9))) AS DOUBLE) / count(*) AS mean_cost FROM {name}_served GROUP BY group_id, sec""")
    def run(spark, d):
        return per_second(L.evaluate_learning(trace(spark, d), POLICIES[name]))
    return run


for _name in POLICIES:
    _evaluate(_name)


SERIES_SQL = "\nUNION ALL ".join(
    ["SELECT 'greedy' AS policy, group_id, sec, CAST(sum(CAST(cost AS DECIMAL(18,9))) AS DOUBLE) / count(*) AS cost, count(*) AS sessions "
     "FROM cc WHERE offered GROUP BY group_id, sec"]
    + [f"SELECT '{n}', group_id, sec, CAST(sum(CAST(cost AS DECIMAL(18,9))) AS DOUBLE) / count(*), count(*) FROM {n}_served GROUP BY group_id, sec"
       for n in POLICIES])


@query("policy_alignment", f"""WITH RECURSIVE {REQ_SQL},
{", ".join(_learn_sql(n) for n in POLICIES)},
series AS ({SERIES_SQL}),
o AS (SELECT *, (row_number() OVER (PARTITION BY policy, group_id ORDER BY sec) - 1) // {BLOCK} AS blk FROM series),
l AS (SELECT policy, group_id, blk, 'cost' AS metric, CAST(cost AS DECIMAL(18,9)) AS v FROM o
      UNION ALL SELECT policy, group_id, blk, 'sessions', CAST(sessions AS DECIMAL(18,9)) FROM o),
b AS (SELECT policy, group_id, metric, (blk + 1) * {BLOCK} AS label, CAST(sum(v) AS DOUBLE) / count(*) AS v FROM l
      GROUP BY policy, group_id, metric, blk HAVING count(*) = {BLOCK})
SELECT group_id, metric, label, {", ".join(f"max(v) FILTER (WHERE policy = '{n}') AS {n}" for n in ("greedy", *POLICIES))}
FROM b GROUP BY group_id, metric, label""")
def policy_alignment_q(spark, d):
    """Each policy's own cost series in blocks of its own seconds, side by side per group and metric; a shorter series leaves nulls."""
    recs = trace(spark, d).select("line_no", "group_id", "sec", "epoch", "decision_map")
    greedy = T.per_second(served(recs), sec="sec", by=("group_id",)).where("n_ok > 0")
    totals = {n: materialize(L.what_if(recs, n)) for n in {p.n_slots for p in POLICIES.values()}}  # policies of as many slots share them
    all_ = [greedy.select(F.lit("greedy").alias("policy"), "group_id", "sec", F.col("mean_cost").alias("cost"), F.col("n_ok").alias("sessions"))]
    all_ += [per_second(L.evaluate_learning(recs, p, totals=totals[p.n_slots])).select(
        F.lit(n).alias("policy"), "group_id", "sec", F.col("mean_cost").alias("cost"), F.col("n_sent").alias("sessions"))
        for n, p in POLICIES.items()]
    placed = with_ordinal(reduce(DataFrame.unionByName, all_), ["sec"], partition_by=["policy", "group_id"])
    metric = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("cost", "sessions")]))
    blocks = S.block_means(placed.select("policy", "group_id", "ord", metric), "ord", "value", BLOCK, partition_by=["policy", "group_id", "metric"])
    return S.pivot_policies(blocks, ["group_id", "metric", "label"], "policy", "mean_value", ["greedy", *POLICIES])
