"""Grouping, routing and subscription queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import adapters as ad
from ..functions import parsing as P
from ..functions.rules import assign_groups, flatten_rules
from ..operators import aggregates as agg
from ..operators import routing as R
from ..operators.joins import small
from ..operators.policies import best_arm
from ..operators.sampling import sample_rows
from .decisions import last_epoch, updates
from .registry import query
from .sqlparts import ORIGIN, UPDATES

OWN = "AMERICA"            # this deployment's cluster
OVERRIDE_SEGMENT = "AUTOMOBILE"
SPLIT_DATE = "1998-01-01"  # subscriber_merge: orders before it form the old registry

NR_SQL = """nr AS (SELECT n_nationkey, n_name, r_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _node(depth: int, field: str | None = None, group=None, table=None):
    """A rule node cast to the uniform bounded-depth type (absent parts are null and omitted
    from the JSON text)."""
    from ..functions.rules import node_schema
    if depth == 0:
        return F.struct(group.alias("GroupName")).cast(node_schema(0))
    return F.struct((F.lit(field) if field else F.lit(None)).cast("string").alias("Field"),
                    (group if group is not None else F.lit(None)).cast("string").alias("GroupName"),
                    (table if table is not None else F.lit(None)).alias("Table")).cast(node_schema(depth))


def rule_document(spark, d, nation_rules: bool = True) -> DataFrame:
    """One rule document derived from the data: under the region (feature 5) a subtree per
    nation (feature 3) whose market segments (feature 2) -- those present among the nation's
    customers -- map to the group ``nation/segment``; later in the document, a per-region override
    for one segment. Later rules win.

    The customer side is cut to distinct (nation, segment) pairs first (partial distinct), so the
    document is bounded by nations x segments, whatever the number of customers.
    """
    nation, region = ad.table(spark, d, "nation"), ad.table(spark, d, "region")
    segs = ad.table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    nr = small(nation.join(small(region), nation.n_regionkey == region.r_regionkey)
               .select("n_nationkey", "n_name", "r_regionkey", "r_name"))
    ns = segs.join(nr, segs.c_nationkey == nr.n_nationkey)
    entry = lambda key, rule: F.struct(key.alias("Key"), rule.alias("Rule"))
    per_nation = ns.groupBy("r_regionkey", "r_name", "n_nationkey", "n_name").agg(
        F.array_sort(F.collect_list("c_mktsegment")).alias("segs"))
    per_nation = per_nation.select(
        "r_regionkey", "r_name", "n_nationkey",
        entry(F.col("n_name"), _node(1, "2", table=F.transform(
            "segs", lambda sg: entry(sg, _node(0, group=F.concat(F.col("n_name"), F.lit("/"), sg)))))).alias("e"))
    per_region = per_nation.groupBy("r_regionkey", "r_name").agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "e"))).alias("ns"))
    entries = per_region.select(
        "r_regionkey",
        entry(F.col("r_name"), _node(2, "3", table=F.transform("ns", lambda x: x["e"]))).alias("nat"),
        entry(F.col("r_name"), _node(2, "2", table=F.array(entry(
            F.lit(OVERRIDE_SEGMENT), _node(1, group=F.concat(F.col("r_name"), F.lit("/" + OVERRIDE_SEGMENT))))))).alias("ovr"))
    rows = F.array_sort(F.collect_list(F.struct("r_regionkey", "nat", "ovr")))
    table = F.transform(rows, lambda x: x["ovr"])
    if nation_rules:
        table = F.concat(F.transform(rows, lambda x: x["nat"]), table)
    return entries.agg(F.to_json(_node(3, "5", table=table)).alias("rules")).select(F.lit(1).alias("doc_id"), "rules")


def rule_paths(spark, d, nation_rules: bool = True) -> DataFrame:
    return flatten_rules(rule_document(spark, d, nation_rules))


@query("rule_paths", f"""WITH {NR_SQL},
ns AS (SELECT DISTINCT r_regionkey, r_name, n_nationkey, n_name, c_mktsegment FROM customer JOIN nr ON c_nationkey = n_nationkey),
paths AS (
  SELECT 0 AS kind, r_regionkey, n_nationkey, c_mktsegment AS seg, 3 AS depth,
         '5=' || r_name || '/3=' || n_name || '/2=' || c_mktsegment AS path, n_name || '/' || c_mktsegment AS group_name FROM ns
  UNION ALL
  SELECT DISTINCT 1 AS kind, r_regionkey, 0, '', 2, '5=' || r_name || '/2={OVERRIDE_SEGMENT}', r_name || '/{OVERRIDE_SEGMENT}' FROM ns)
SELECT 1 AS doc_id, row_number() OVER (ORDER BY kind, r_regionkey, n_nationkey, seg) AS rule_no,
       CAST(depth AS INTEGER) AS depth, path, group_name FROM paths""")
def rule_paths_q(spark, d):
    p = rule_paths(spark, d)
    return p.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("rule_order"))
                    .cast("bigint").alias("rule_no"),
                    F.size("path").alias("depth"),
                    F.array_join(F.transform("path", lambda x: F.concat(x["field"].cast("string"), F.lit("="), x["key"])),
                                 "/").alias("path"), "group_name")


DEEP_FIELDS = ("5", "3", "2", "4", "1", "0")   # six levels


def deep_rules(spark, d) -> DataFrame:
    """A document with one rule of six levels per (nation, segment) of the customers."""
    nation, region = ad.table(spark, d, "nation"), ad.table(spark, d, "region")
    segs = ad.table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    nr = small(nation.join(small(region), nation.n_regionkey == region.r_regionkey))
    keys = (F.col("r_name"), F.col("n_name"), F.col("c_mktsegment"), F.col("n_nationkey").cast("string"), F.lit("x{"), F.lit("y"))
    rule = _node(0, group=F.concat(F.col("n_name"), F.lit("/"), F.col("c_mktsegment")))
    for level in range(5, 0, -1):
        rule = _node(6 - level, DEEP_FIELDS[level], table=F.array(F.struct(keys[level].alias("Key"), rule.alias("Rule"))))
    entry = F.struct(keys[0].alias("Key"), rule.alias("Rule"))
    rows = (segs.join(nr, segs.c_nationkey == nr.n_nationkey)
            .agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "c_mktsegment", entry.alias("e")))).alias("rows")))
    table = F.transform("rows", lambda r: r["e"])
    return rows.select(F.lit(1).alias("doc_id"), F.to_json(_node(6, DEEP_FIELDS[0], table=table)).alias("rules"))


@query("rule_paths_deep", f"""WITH {NR_SQL},
ns AS (SELECT DISTINCT r_name, n_nationkey, n_name, c_mktsegment FROM customer JOIN nr ON c_nationkey = n_nationkey)
SELECT row_number() OVER (ORDER BY n_nationkey, c_mktsegment) - 1 AS rule_no, 6 AS depth,
       '5=' || r_name || '/3=' || n_name || '/2=' || c_mktsegment || '/4=' || n_nationkey || '/1=x{{/0=y' AS path,
       n_name || '/' || c_mktsegment AS group_name FROM ns""")
def rule_paths_deep_q(spark, d):
    p = flatten_rules(deep_rules(spark, d))
    path = F.transform("path", lambda x: F.concat(x["field"].cast("string"), F.lit("="), x["key"]))
    return p.select(F.get("rule_order", 0).cast("bigint").alias("rule_no"), F.size("path").alias("depth"),
                    F.array_join(path, "/").alias("path"), "group_name")


def _customers(spark, d):
    c = ad.customer_payloads(ad.table(spark, d, "customer"), ad.table(spark, d, "nation"), ad.table(spark, d, "region"))
    return c.withColumn("features", P.split_features("payload"))


@query("rule_group", f"""WITH {NR_SQL}
SELECT c_custkey, CASE WHEN c_mktsegment = '{OVERRIDE_SEGMENT}' AND r_name IS NOT NULL THEN r_name || '/{OVERRIDE_SEGMENT}'
                       WHEN n_name IS NOT NULL THEN n_name || '/' || c_mktsegment END AS group_id
FROM customer LEFT JOIN nr ON c_nationkey = n_nationkey""")
def rule_group_q(spark, d):
    c = assign_groups(_customers(spark, d), "features", rule_paths(spark, d))
    return c.select("c_custkey", F.col("rule_group").alias("group_id"))


@query("default_group", f"""WITH {NR_SQL},
g AS (SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment = '{OVERRIDE_SEGMENT}' AND r_name IS NOT NULL
                                      THEN r_name || '/{OVERRIDE_SEGMENT}' END AS rg
      FROM customer LEFT JOIN nr ON c_nationkey = n_nationkey)
SELECT c_custkey, coalesce(rg, CAST(c_nationkey AS VARCHAR)) AS group_asn, coalesce(rg, 'null') AS group_null FROM g""")
def default_group_q(spark, d):
    c = assign_groups(_customers(spark, d), "features", rule_paths(spark, d, nation_rules=False))
    return c.select("c_custkey", P.default_group("rule_group", "features", "asn").alias("group_asn"),
                    P.default_group("rule_group", "features", "null").alias("group_null"))


KEPT_LABELS = ("custkey", "nation", "segment")


@query("reduce_labels", f"""WITH {NR_SQL}
SELECT c_custkey, CAST(c_custkey AS VARCHAR) || chr(9) || coalesce(n_name, '') || chr(9) || c_mktsegment AS reduced
FROM customer LEFT JOIN nr ON c_nationkey = n_nationkey""")
def reduce_labels_q(spark, d):
    c = _customers(spark, d)
    return c.select("c_custkey", P.project_labels("payload", ad.CUSTOMER_LABELS, KEPT_LABELS).alias("reduced"))


def _assignments(spark, d) -> DataFrame:
    nation, region = ad.table(spark, d, "nation"), ad.table(spark, d, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("group_name"), F.col("r_name").alias("cluster"))


def routed(spark, d) -> DataFrame:
    c = _customers(spark, d).select(
        "c_custkey", F.col("n_name").alias("group_id"),
        F.concat(F.col("c_mktsegment"), F.lit("\t"), F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("update"))
    return R.route(c, _assignments(spark, d), OWN)


ROUTED_SQL = f"""{NR_SQL},
rt AS (
  SELECT c_custkey, n_name AS group_id, coalesce(r_name, '{OWN}') AS cluster_id,
         c_mktsegment || chr(9) || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS upd
  FROM customer LEFT JOIN nr ON c_nationkey = n_nationkey),
routed AS (
  SELECT c_custkey, group_id, cluster_id,
         CASE WHEN cluster_id = '{OWN}' THEN 'internal_groups' ELSE 'external_groups' END AS topic,
         '{{"update":"' || replace(upd, chr(9), '\\t') || '","group_id":"' || group_id || '","cluster_id":"' || cluster_id || '"}}' AS message
  FROM rt)"""


@query("route_updates", f"""WITH {ROUTED_SQL}
SELECT c_custkey, group_id, cluster_id, topic, message FROM routed""")
def route_updates_q(spark, d):
    return routed(spark, d).select("c_custkey", "group_id", "cluster_id", "topic", "message")


@query("forward_external", f"""WITH {ROUTED_SQL}
SELECT c_custkey, cluster_id AS dest_cluster, 'internal_groups' AS topic, message AS value
FROM routed WHERE topic = 'external_groups'""")
def forward_external_q(spark, d):
    r = routed(spark, d).where(F.col("topic") == R.EXTERNAL)
    return r.select("c_custkey", F.col("cluster_id").alias("dest_cluster"), F.lit(R.INTERNAL).alias("topic"),
                    F.col("message").alias("value"))


@query("subscribe_first", f"""WITH {ROUTED_SQL}
SELECT group_id, arg_min(cluster_id, c_custkey) AS dest_cluster, group_id || ';{OWN}' AS message
FROM routed WHERE topic = 'external_groups' GROUP BY group_id""")
def subscribe_first_q(spark, d):
    r = routed(spark, d).where(F.col("topic") == R.EXTERNAL)
    return R.subscribe_to_owners(r, OWN, offset="c_custkey")


# ---- feature frequency over a 1 % sample -----------------------------------------------------------

SAMPLE_FRACTION = 0.01


def _order_payloads(spark, d):
    o = ad.table(spark, d, "orders")
    payload = P.tsv("o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("string"),
                    F.floor(F.col("o_totalprice") / 100000).cast("string"),
                    F.lit("decision"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    return o.select("o_orderkey", payload.alias("payload"))


@query("feature_frequency", """WITH s AS (
  SELECT list_value(o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS VARCHAR),
                    CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR)) AS f
  FROM orders WHERE o_orderkey % 100 = 0),
e AS (SELECT unnest(range(0, 4)) AS feature_index, f FROM s)
SELECT CAST(feature_index AS INTEGER) AS feature_index, f[feature_index + 1] AS feature_value, count(*) AS n,
       CAST(0.01 AS DOUBLE) AS sample_fraction
FROM e GROUP BY ALL""")
def feature_frequency_q(spark, d):
    s = sample_rows(_order_payloads(spark, d), "o_orderkey", SAMPLE_FRACTION, method="key_mod")
    pairs = P.feature_pairs(s, "payload", n_management=2)
    return agg.feature_frequency(pairs).withColumn("sample_fraction", F.lit(SAMPLE_FRACTION))


# ---- subscriptions over the order graph ---------------------------------------------------------

def brand_region_pairs(spark, d, orders_filter=None, flag=None) -> DataFrame:
    """(p_brand, r_name) pairs: which clusters (regions) buy which groups (brands).

    lineitem is the fact table: it is joined to the (order -> region) map on the order key, cut to
    distinct (partkey, region) pairs -- a partial distinct runs before the next shuffle -- and
    only then joined to part.
    """
    o = ad.table(spark, d, "orders")
    if orders_filter is not None:
        o = o.where(orders_filter)
    extra = []
    if flag is not None:   # carry a per-order flag through to the pairs (one pass for both sides)
        o = o.withColumn("_flag", flag)
        extra = ["_flag"]
    c, n, r = (ad.table(spark, d, t) for t in ("customer", "nation", "region"))
    nr = small(n.join(small(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    cr = c.select("c_custkey", "c_nationkey").join(nr, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    orr = o.select("o_orderkey", "o_custkey", *extra).join(cr, F.col("o_custkey") == F.col("c_custkey")) \
        .select("o_orderkey", "r_name", *extra)
    li = ad.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    pr = li.join(orr, F.col("l_orderkey") == F.col("o_orderkey")).select("l_partkey", "r_name", *extra).distinct()
    p = ad.table(spark, d, "part").select("p_partkey", "p_brand")
    return (pr.join(p, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("p_brand").alias("group_id"), F.col("r_name").alias("cluster_id"), *extra).distinct())


PAIRS_SQL = """pairs_all AS (
  SELECT DISTINCT p_brand AS group_id, r_name AS cluster_id, o_orderdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""


@query("subscriber_sets", f"""WITH {PAIRS_SQL}, pairs AS (SELECT DISTINCT group_id, cluster_id FROM pairs_all)
SELECT group_id, string_agg(cluster_id, ',' ORDER BY cluster_id) AS subscribers, count(*) AS n_subscribers
FROM pairs GROUP BY group_id""")
def subscriber_sets_q(spark, d):
    s = R.subscriber_sets(brand_region_pairs(spark, d))
    return s.select("group_id", F.array_join("subscribers", ",").alias("subscribers"),
                    F.size("subscribers").cast("bigint").alias("n_subscribers"))


@query("subscriber_merge", f"""WITH {PAIRS_SQL},
old AS (SELECT DISTINCT group_id, cluster_id FROM pairs_all WHERE o_orderdate < DATE '{SPLIT_DATE}'),
new AS (SELECT DISTINCT group_id, cluster_id FROM pairs_all WHERE o_orderdate >= DATE '{SPLIT_DATE}'),
m AS (SELECT * FROM old UNION SELECT * FROM new),
g AS (SELECT DISTINCT group_id FROM m)
SELECT g.group_id,
       (SELECT count(*) FROM old WHERE old.group_id = g.group_id) AS n_old,
       (SELECT count(*) FROM new WHERE new.group_id = g.group_id) AS n_new,
       (SELECT count(*) FROM m WHERE m.group_id = g.group_id) AS n_merged,
       (SELECT string_agg(cluster_id, ',' ORDER BY cluster_id) FROM m WHERE m.group_id = g.group_id) AS subscribers
FROM g""")
def subscriber_merge_q(spark, d):
    # one pass over the order graph: each (group, cluster) pair carries whether it comes from the
    # old orders (the registry) or the new ones (the incoming subscriptions)
    pairs = brand_region_pairs(spark, d, flag=F.col("o_orderdate") >= F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    return (pairs.groupBy("group_id")
            .agg(F.count_if(~F.col("_flag")).alias("n_old"), F.count_if(F.col("_flag")).alias("n_new"),
                 F.array_sort(F.collect_set("cluster_id")).alias("subscribers"))   # U2: set union
            .select("group_id", "n_old", "n_new", F.size("subscribers").cast("bigint").alias("n_merged"),
                    F.array_join("subscribers", ",").alias("subscribers")))


@query("decision_fanout", f"""WITH {PAIRS_SQL}, pairs AS (SELECT DISTINCT group_id, cluster_id FROM pairs_all),
t AS (SELECT p_brand AS group_id, l_returnflag AS decision,
             CAST(-sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_score
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
b AS (SELECT group_id, decision AS best FROM (
        SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY mean_score DESC, decision) AS rn FROM t) WHERE rn = 1)
SELECT p.cluster_id, b.group_id, b.group_id || ';' || b.best || ':;From: {ORIGIN}' AS message
FROM b JOIN pairs p ON p.group_id = b.group_id WHERE p.cluster_id <> '{OWN}'""")
def decision_fanout_q(spark, d):
    li = ad.table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_discount")
    p = ad.table(spark, d, "part").select("p_partkey", "p_brand")
    t = agg.arm_totals(li.join(p, F.col("l_partkey") == F.col("p_partkey"))
                       .select(F.col("p_brand").alias("group_id"), F.col("l_returnflag").alias("decision"),
                               F.col("l_discount").alias("cost")))
    b = best_arm(t)
    dec = b.select("group_id", P.decision_message(F.col("group_id"), F.concat(F.col("best"), F.lit(":")), ORIGIN).alias("message"))
    return R.fan_out(dec, brand_region_pairs(spark, d), OWN).select("cluster_id", "group_id", "message")


# ---- the group table as of each update -------------------------------------------------------------

N_OWNERS = 5  # clusters of the derived assignments; c0 is the own one


@query("route_as_of", f"""WITH chg AS (
  SELECT CAST(user_id % 8 AS VARCHAR) AS group_id, epoch_us(ts) AS since_us, arg_max('c' || user_id % {N_OWNERS}, event_id) AS owner
  FROM events WHERE event_type = 'signup' GROUP BY ALL),
upd AS (SELECT event_id, CAST(user_id % 8 AS VARCHAR) AS group_id, epoch_us(ts) AS ts_us FROM events WHERE event_type <> 'signup'),
j AS (SELECT upd.event_id, upd.group_id, coalesce(chg.owner, 'c0') AS cluster_id
      FROM upd ASOF LEFT JOIN chg ON upd.group_id = chg.group_id AND upd.ts_us >= chg.since_us)
SELECT event_id, group_id, cluster_id, CASE WHEN cluster_id = 'c0' THEN 'internal_groups' ELSE 'external_groups' END AS topic FROM j""")
def route_as_of_q(spark, d):
    """A sign-up stands for a message that assigns its group to a cluster from its time on; the other events are updates."""
    e = ad.table(spark, d, "events").select("event_id", "event_type", "user_id", ad.ts_micros("ts").alias("ts_us"),
                                            (F.col("user_id") % ad.N_USER_GROUPS).cast("string").alias("group_id"))
    changes = e.where("event_type = 'signup'").select(
        F.col("group_id").alias("group_name"), F.concat(F.lit("c"), (F.col("user_id") % N_OWNERS).cast("string")).alias("cluster"),
        F.col("ts_us").alias("since_us"), F.col("event_id").alias("offset"))
    updates_ = e.where("event_type <> 'signup'").select("event_id", "group_id", "ts_us", F.col("event_type").alias("update"))
    routed = R.route_as_of(updates_, changes, "c0", "ts_us", "since_us", "offset")
    return routed.select("event_id", "group_id", "cluster_id", "topic")


# ---- latest-wins tables, heartbeats, drains ---------------------------------------------------------

@query("latest_assignment", """SELECT CAST(user_id AS VARCHAR) AS group_id, arg_max(event_type, event_id) AS cluster_id,
       max(event_id) AS "offset" FROM events GROUP BY user_id""")
def latest_assignment_q(spark, d):
    e = ad.table(spark, d, "events").select(F.col("user_id").cast("string").alias("group_id"),
                                            F.col("event_type").alias("cluster_id"), F.col("event_id").alias("offset"))
    return R.latest_assignment(e, "group_id", "cluster_id", "offset")


@query("group_table_latest", """WITH a AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS group_name, event_type AS cluster FROM events WHERE event_type <> 'error'
  UNION ALL SELECT event_id, 'g' || user_id % 8, event_type FROM events WHERE event_type <> 'error')
SELECT group_name, arg_max(cluster, event_id) AS cluster, max(event_id) AS "offset" FROM a GROUP BY group_name""")
def group_table_latest_q(spark, d):
    """Every event is a message that assigns two groups; error events carry rules only."""
    e = ad.table(spark, d, "events")
    entry = lambda name: F.struct(name.alias("GroupName"), F.col("event_type").alias("Cluster"))
    both = F.array(entry(F.col("user_id").cast("string")), entry(F.concat(F.lit("g"), (F.col("user_id") % 8).cast("string"))))
    msg = F.struct(F.when(F.col("event_type") != "error", both).alias("GroupAssignment"),
                   F.when(F.col("event_type") == "error", F.struct(F.lit("all").alias("GroupName"))).alias("GroupingRules"))
    return R.group_table(e.select(F.col("event_id").alias("offset"), F.to_json(msg).alias("value")))


def decision_stream(spark, d) -> DataFrame:
    """events -> epsilon-greedy decision messages ``(offset, value)`` for the collector."""
    e = ad.table(spark, d, "events")
    others = F.array_remove(F.array(*[F.lit(t) for t in ad.event_types(e)]), F.col("event_type"))
    eps = F.concat(F.lit("0."), F.lpad(F.get_json_object("props", "$.k"), 2, "0"))
    payload = F.concat(F.lit('{"random":['), F.array_join(F.transform(others, lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ","),
                       F.lit('],"best":"'), F.col("event_type"), F.lit('","epsilon":'), eps, F.lit("}"))
    return e.select(F.col("event_id").alias("offset"),
                    P.decision_message(F.col("user_id").cast("string"), payload, ORIGIN).alias("value"))


@query("latest_decision", f"""WITH m AS (
  SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS group_id,
         '{{"random":[' || array_to_string(list_transform(list_filter(['click','error','purchase','signup','view'], lambda x: x <> event_type), lambda x: '"' || x || '"'), ',')
         || '],"best":"' || event_type || '","epsilon":0.' || lpad(json_extract_string(props, '$.k'), 2, '0') || '}}' AS payload
  FROM events),
l AS (SELECT group_id, arg_max(payload, "offset") AS payload, max("offset") AS "offset" FROM m GROUP BY group_id)
SELECT group_id, json_extract_string(payload, '$.best') AS best, CAST(json_extract(payload, '$.epsilon') AS DOUBLE) AS epsilon,
       array_to_string(CAST(json_extract(payload, '$.random') AS VARCHAR[]), ',') AS others, "offset"
FROM l""")
def latest_decision_q(spark, d):
    m = decision_stream(spark, d)
    parsed = P.parse_decision_message("value")
    m = m.select("offset", parsed["group_id"].alias("group_id"), parsed["payload"].alias("payload"))
    latest = R.latest_assignment(m, "group_id", "payload", "offset")
    eg = P.parse_eg_payload("payload")
    return latest.select("group_id", eg["best"].alias("best"), eg["epsilon"].alias("epsilon"),
                         F.array_join(eg["random"], ",").alias("others"), "offset")


@query("heartbeat_liveness", f"""WITH {UPDATES},
b AS (SELECT DISTINCT decision AS cluster_id, epoch FROM updates),
g AS (SELECT *, epoch - lag(epoch) OVER (PARTITION BY cluster_id ORDER BY epoch) AS gap FROM b)
SELECT cluster_id, count(*) AS n_beats, max(epoch) AS last_batch, CAST(coalesce(max(gap), 0) AS BIGINT) AS max_gap,
       max(epoch) >= (SELECT max(epoch) FROM updates) - 1 AS alive
FROM g GROUP BY cluster_id""")
def heartbeat_liveness_q(spark, d):
    u = updates(spark, d)
    beats = u.select(F.col("decision").alias("cluster_id"), "epoch")
    return R.liveness(beats, last_epoch(u))


@query("records_per_drain", f"""WITH {UPDATES}
SELECT epoch, count(*) AS n_records FROM updates GROUP BY epoch""")
def records_per_drain_q(spark, d):
    return agg.records_per_batch(updates(spark, d))


# ---- hash routes and the proxy table -----------------------------------------------------------------

@query("hash_route", """WITH routes AS (
  SELECT md5(c_mktsegment || '&' || n_name) AS route_key, o_orderpriority || ':' || CAST(o_custkey AS VARCHAR) AS address, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT route_key, arg_min(address, o_orderkey) AS address FROM routes GROUP BY route_key),
req AS (SELECT c_custkey, md5(c_mktsegment || '&' || n_name) AS route_key FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, req.route_key, address FROM req LEFT JOIN f ON req.route_key = f.route_key""")
def hash_route_q(spark, d):
    c, n, o = (ad.table(spark, d, t) for t in ("customer", "nation", "orders"))
    cn = c.join(small(n), c.c_nationkey == n.n_nationkey, "left").select(
        "c_custkey", P.route_key("c_mktsegment", "n_name").alias("route_key"))
    # route table as ``md5hex;address`` lines (the file format), in order-key order
    lines = (o.select("o_orderkey", "o_custkey", "o_orderpriority")
             .join(cn, F.col("o_custkey") == F.col("c_custkey"))
             .select("o_orderkey", F.concat_ws(";", "route_key", F.concat_ws(":", "o_orderpriority",
                                                                              F.col("o_custkey").cast("string"))).alias("line")))
    parts = F.split("line", ";", 2)
    routes = lines.select("o_orderkey", F.get(parts, 0).alias("route_key"), F.get(parts, 1).alias("address"))
    first = R.first_route(routes, "route_key", "address", "o_orderkey")
    return cn.join(small(first), "route_key", "left").select("c_custkey", "route_key", "address")


@query("first_route", """SELECT p_name AS server_ip, p_size AS server_port FROM part ORDER BY p_partkey LIMIT 1""")
def first_route_q(spark, d):
    p = ad.table(spark, d, "part")
    return p.orderBy("p_partkey").limit(1).select(F.col("p_name").alias("server_ip"), F.col("p_size").alias("server_port"))
