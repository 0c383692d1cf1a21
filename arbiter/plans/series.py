"""Series, block, inter-arrival and latency queries over events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import adapters as ad
from ..functions.parsing import succeeded
from ..operators import aggregates as agg
from ..operators import series as S
from ..operators.ordinal import with_ordinal
from .registry import query

ROLL = 60
BLOCK_SRC = 100
ACK_BLOCK = 100
GAP_BLOCK = 10
HORIZON = 86_400  # seconds of silence given one by one
SERIES_A, SERIES_B = "click", "view"

ORD_SQL = "s AS (SELECT event_id, event_type, value, epoch_us(ts) AS us, row_number() OVER (ORDER BY event_id) - 1 AS ord FROM events)"


def by_id(spark, d) -> DataFrame:
    e = ad.table(spark, d, "events").select("event_id", "event_type", "value", ad.ts_micros("ts").alias("us"))
    return with_ordinal(e, ["event_id"])


@query("block_mean_60", f"""WITH {ORD_SQL},
b AS (SELECT ord // {ROLL} AS blk, sum(CAST(value AS DECIMAL(18,2))) AS s, count(*) AS n FROM s GROUP BY 1)
SELECT (blk + 1) * {ROLL} AS label, CAST(s AS DOUBLE) / n AS mean_value FROM b WHERE n = {ROLL}""")
def block_mean_60_q(spark, d):
    return S.block_means(by_id(spark, d), "ord", "value", ROLL)


@query("rolling_mean_60", f"""WITH {ORD_SQL}
SELECT event_id, ord, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS rolling_mean
FROM s WINDOW w AS (ORDER BY ord ROWS BETWEEN {ROLL - 1} PRECEDING AND CURRENT ROW)""")
def rolling_mean_60_q(spark, d):
    return S.rolling_mean(by_id(spark, d), "ord", "value", ROLL).select("event_id", "ord", "rolling_mean")


SRC_SQL = f"""src AS (SELECT event_type AS source, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS ord FROM events),
sb AS (SELECT source, ord // {BLOCK_SRC} AS blk, sum(CAST(value AS DECIMAL(18,2))) AS s, count(*) AS n FROM src GROUP BY 1, 2),
blocks AS (SELECT source, (blk + 1) * {BLOCK_SRC} AS label, CAST(s AS DOUBLE) / n AS mean_value FROM sb WHERE n = {BLOCK_SRC})"""


def source_blocks(spark, d, only: tuple[str, ...] = ()) -> DataFrame:
    """Block means per source; ``only`` these sources, dropped before the ranks are made."""
    e = ad.table(spark, d, "events").select(F.col("event_type").alias("source"), "event_id", "value")
    e = e.where(F.col("source").isin(*only)) if only else e
    return S.block_means(with_ordinal(e, ["event_id"], partition_by=["source"]), "ord", "value", BLOCK_SRC,
                         partition_by=["source"])


@query("block_mean_100_by_source", f"""WITH {SRC_SQL} SELECT source, label, mean_value FROM blocks""")
def block_mean_100_by_source_q(spark, d):
    return source_blocks(spark, d)


@query("zip_series", f"""WITH {SRC_SQL}
SELECT a.label, a.mean_value AS a, b.mean_value AS b
FROM blocks a JOIN blocks b ON a.label = b.label WHERE a.source = '{SERIES_A}' AND b.source = '{SERIES_B}'""")
def zip_series_q(spark, d):
    bl = source_blocks(spark, d, (SERIES_A, SERIES_B))
    return S.zip_series(bl.where(F.col("source") == SERIES_A), bl.where(F.col("source") == SERIES_B))


@query("series_length_gap", f"""WITH {SRC_SQL}
SELECT count(*) FILTER (WHERE source = '{SERIES_A}') AS n_a, count(*) FILTER (WHERE source = '{SERIES_B}') AS n_b,
       abs(count(*) FILTER (WHERE source = '{SERIES_A}') - count(*) FILTER (WHERE source = '{SERIES_B}')) AS gap
FROM blocks""")
def series_length_gap_q(spark, d):
    bl = source_blocks(spark, d, (SERIES_A, SERIES_B))
    return S.length_gap(bl.where(F.col("source") == SERIES_A), bl.where(F.col("source") == SERIES_B))


@query("policy_pivot", f"""WITH l AS (
  SELECT CAST(user_id % 8 AS VARCHAR) AS group_id, (epoch_us(ts) - {ad.EPOCH_BASE_US}) // 3600000000 AS i,
         event_type AS policy, sum(CAST(value AS DECIMAL(18,2))) AS s, count(*) AS n FROM events GROUP BY ALL),
m AS (SELECT 'cost' AS feature_type, group_id, i, policy, CAST(s AS DOUBLE) / n AS v FROM l
      UNION ALL SELECT 'sessions', group_id, i, policy, CAST(n AS DOUBLE) FROM l)
SELECT feature_type, group_id, i, {", ".join(f"max(v) FILTER (WHERE policy = '{p}') AS {p}" for p in ad.EVENT_TYPES)}
FROM m GROUP BY feature_type, group_id, i""")
def policy_pivot_q(spark, d):
    e = ad.table(spark, d, "events")
    l = (e.groupBy((F.col("user_id") % 8).cast("string").alias("group_id"),
                   F.floor((ad.ts_micros("ts") - ad.EPOCH_BASE_US) / 3600000000).cast("bigint").alias("i"),
                   F.col("event_type").alias("policy"))
         .agg(F.sum(ad.exact("value")).alias("s"), F.count(F.lit(1)).alias("n")))
    long = (l.select(F.lit("cost").alias("feature_type"), "group_id", "i", "policy",
                     (F.col("s").cast("double") / F.col("n")).alias("v"))
            .unionByName(l.select(F.lit("sessions").alias("feature_type"), "group_id", "i", "policy",
                                  F.col("n").cast("double").alias("v"))))
    return S.pivot_policies(long, ["feature_type", "group_id", "i"], "policy", "v", ad.event_types(e))


TS_SQL = "t AS (SELECT event_id, epoch_us(ts) AS us, row_number() OVER (ORDER BY ts, event_id) - 1 AS ord FROM events)"


def by_time(spark, d) -> DataFrame:
    e = ad.table(spark, d, "events").select("event_id", ad.ts_micros("ts").alias("us"))
    return with_ordinal(e, ["us", "event_id"])


@query("interarrival_gap", f"""WITH {TS_SQL}
SELECT event_id, ord, CAST(us - lag(us) OVER (ORDER BY ord) AS DOUBLE) / 1000000 AS gap FROM t""")
def interarrival_gap_q(spark, d):
    return S.gaps(by_time(spark, d), "ord", "us").select("event_id", "ord", "gap")


@query("interarrival_block10", f"""WITH {TS_SQL},
g AS (SELECT ord, us - lag(us) OVER (ORDER BY ord) AS gap_us FROM t)
SELECT ord // {GAP_BLOCK} AS block, count(*) AS n, CAST(sum(gap_us) AS DOUBLE) / count(*) / 1000000 AS mean_gap
FROM g WHERE gap_us IS NOT NULL GROUP BY 1""")
def interarrival_block10_q(spark, d):
    g = S.gaps(by_time(spark, d), "ord", "us", name="_g").where(F.col("_g").isNotNull())
    return (g.groupBy(F.floor(F.col("ord") / GAP_BLOCK).cast("bigint").alias("block"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("_g") * 1000000).cast("bigint")).alias("_s"))
            .select("block", "n", (F.col("_s").cast("double") / F.col("n") / 1000000).alias("mean_gap")))


@query("ack_block_time", f"""WITH {TS_SQL},
b AS (SELECT ord // {ACK_BLOCK} AS blk, max(us) AS last_us, min(us) AS first_us, count(*) AS n FROM t GROUP BY 1),
l AS (SELECT *, lag(last_us) OVER (ORDER BY blk) AS prev FROM b)
SELECT (blk + 1) * {ACK_BLOCK} AS total_acked, CAST(last_us - coalesce(prev, first_us) AS DOUBLE) / 1000000 AS secs
FROM l WHERE n = {ACK_BLOCK}""")
def ack_block_time_q(spark, d):
    return S.ack_blocks(by_time(spark, d), "ord", "us", ACK_BLOCK)


# ---- latency reports: events as request outcomes (sent = ts, response time = value seconds) ------------

OUT_SQL = """o AS (SELECT event_id, epoch_us(ts) AS sent_us, CAST(CAST(value AS DECIMAL(18,2)) * 1000000 AS BIGINT) AS rt_us,
                  event_type <> 'error' AS ok FROM events),
ok AS (SELECT *, sent_us + rt_us AS recv_us FROM o WHERE ok),
st AS (SELECT min(sent_us) AS s FROM ok)"""


def outcomes(spark, d) -> DataFrame:
    e = ad.table(spark, d, "events")
    return e.select("event_id", ad.ts_micros("ts").alias("sent_us"),
                    (ad.exact("value") * 1000000).cast("bigint").alias("rt_us"),
                    succeeded((F.col("event_type") != "error").cast("int")).alias("ok"))


def ok_outcomes(spark, d) -> DataFrame:
    """Successful outcomes only."""
    return outcomes(spark, d).where("ok").withColumn("recv_us", F.col("sent_us") + F.col("rt_us"))


def _series_sql(col: str) -> str:
    return f"""WITH {OUT_SQL},
b AS (SELECT greatest(0, (({col} - st.s + 999999) // 1000000) - 1) AS sec, rt_us FROM ok, st),
p AS (SELECT sec, sum(rt_us) AS s, count(*) AS n FROM b GROUP BY sec),
sp AS (SELECT unnest(range(0, (SELECT max(sec) FROM p) + 1)) AS sec)
SELECT sp.sec, coalesce(CAST(p.s AS DOUBLE) / p.n / 1000000, 0.0) AS mean_rt, coalesce(p.n, 0) AS n
FROM sp LEFT JOIN p ON sp.sec = p.sec"""


def _series(spark, d, col):
    ok = ok_outcomes(spark, d)
    start = int(ok.agg(F.min("sent_us")).first()[0] or 0)
    return S.latency_series(ok, col, "rt_us", start, HORIZON).select("sec", "mean_rt", "n")


@query("latency_by_sent", _series_sql("sent_us"))
def latency_by_sent_q(spark, d):
    return _series(spark, d, "sent_us")


@query("latency_by_received", _series_sql("recv_us"))
def latency_by_received_q(spark, d):
    return _series(spark, d, "recv_us")


@query("latency_summary", f"""WITH {OUT_SQL}
SELECT count(*) AS n_sent, count(*) FILTER (WHERE ok) AS n_ok,
       CAST(sum(rt_us) FILTER (WHERE ok) AS DOUBLE) / count(*) FILTER (WHERE ok) / 1000000 AS mean_rt FROM o""")
def latency_summary_q(spark, d):
    o = outcomes(spark, d)
    return o.agg(F.count(F.lit(1)).alias("n_sent"), F.count_if("ok").alias("n_ok"),
                 (F.sum(F.when(F.col("ok"), F.col("rt_us"))).cast("double") / F.count_if("ok") / 1000000).alias("mean_rt"))


@query("latency_cdf", f"""WITH {OUT_SQL}
SELECT CAST(rt_us AS DOUBLE) / 1000000 AS rt, (row_number() OVER (ORDER BY rt_us, event_id) - 1) * 100 / count(*) OVER () AS pct
FROM ok""")
def latency_cdf_q(spark, d):
    c = S.cdf(ok_outcomes(spark, d), "rt_us", "event_id")
    return c.select((F.col("rt_us").cast("double") / 1000000).alias("rt"), "pct")


@query("latency_p90", f"""WITH {OUT_SQL},
r AS (SELECT rt_us, row_number() OVER (ORDER BY rt_us, event_id) - 1 AS k, count(*) OVER () AS n FROM ok)
SELECT n, CAST(rt_us AS DOUBLE) / 1000000 AS p90 FROM r WHERE k = (9 * n) // 10""")
def latency_p90_q(spark, d):
    p = S.percentile_at(ok_outcomes(spark, d), "rt_us", 9, 10)
    return p.select("n", (F.col("p").cast("double") / 1000000).alias("p90"))


@query("run_rollup", """WITH w AS (SELECT user_id, count(*) AS sent, max(epoch_us(ts)) - min(epoch_us(ts)) AS dur_us FROM events GROUP BY user_id)
SELECT CAST(sum(sent) AS BIGINT) AS total_sent, CAST(sum(dur_us) AS DOUBLE) / count(*) / 1000000 AS mean_seconds,
       sum(sent) / (CAST(sum(dur_us) AS DOUBLE) / count(*) / 1000000) AS offered_rps, count(*) AS n_workers FROM w""")
def run_rollup_q(spark, d):
    e = ad.table(spark, d, "events")
    w = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("sent"),
                                 (F.max(ad.ts_micros("ts")) - F.min(ad.ts_micros("ts"))).alias("dur_us"))
    return agg.run_rollup(w)


# ---- load-tool reports: one report text per (type, brand) run, scraped by label --------------------------

def reports(spark, d) -> DataFrame:
    p = ad.table(spark, d, "part")
    runs = p.groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("n"), F.max(ad.exact("p_retailprice")).alias("hi"),
                                              F.min(ad.exact("p_retailprice")).alias("lo"))
    text = F.concat_ws("\n", F.lit("Concurrency Level:      7"),
                       F.concat(F.lit("Complete requests:      "), F.col("n").cast("string")),
                       F.concat(F.lit("Requests per second:    "), F.col("hi").cast("string"), F.lit(" [#/sec] (mean)")),
                       F.concat(F.lit("Time per request:       "), F.col("lo").cast("string"), F.lit(" [ms] (mean)")),
                       F.concat(F.lit("Time per request:       "), (F.col("lo") / 7).cast("decimal(18,3)").cast("string"),
                                F.lit(" [ms] (mean, across all concurrent requests)")))
    return runs.select("p_type", "p_brand", text.alias("report"))


@query("report_scrape", """WITH r AS (SELECT p_type, p_brand, max(CAST(p_retailprice AS DECIMAL(18,2))) AS hi,
                  min(CAST(p_retailprice AS DECIMAL(18,2))) AS lo FROM part GROUP BY ALL)
SELECT p_type, count(*) AS n_runs, CAST(sum(hi) AS DOUBLE) / count(*) AS avg_rps, CAST(sum(lo) AS DOUBLE) / count(*) AS avg_tpr
FROM r GROUP BY p_type""")
def report_scrape_q(spark, d):
    r = reports(spark, d)
    rps = F.regexp_extract("report", r"Requests per second:\s+([0-9.]+)", 1)
    tpr = F.regexp_extract("report", r"Time per request:\s+([0-9.]+) \[ms\] \(mean\)", 1)
    s = r.select("p_type", rps.cast("decimal(18,2)").alias("rps"), tpr.cast("decimal(18,2)").alias("tpr"))
    return s.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_runs"),
                                   (F.sum("rps").cast("double") / F.count(F.lit(1))).alias("avg_rps"),
                                   (F.sum("tpr").cast("double") / F.count(F.lit(1))).alias("avg_tpr"))
