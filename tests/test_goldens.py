"""Hand-worked cases (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from arbiter.functions import parsing as P
from arbiter.functions.rules import assign_groups, flatten_rules
from arbiter.operators import aggregates as agg
from arbiter.operators import discount, policies, routing, serving, series, traces
from arbiter.operators.ordinal import with_ordinal


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_g1_parse(spark):
    msgs = ['{"update":"cdnA\\t10.0","group_id":"7018"}', "not json", '{"group_id":"g"}',
            '{"group_id":"g","update":"cdnA"}', '{"group_id":"g","update":"cdnA\\tabc"}']
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "id INT, value STRING")
    ok, bad = P.parse_updates(df, keep=("id",))
    assert rows(ok, "group_id", "decision", "score", "cnt") == [("7018", "cdnA", -10.0, 1.0)]
    assert rows(bad, "id", "reason") == [(1, "not_json"), (2, "missing_update"), (3, "missing_cost"), (4, "bad_cost")]


def _g2_updates(spark):
    data = [("g", "a", 1, 10.0), ("g", "a", 1, 20.0), ("g", "b", 2, 8.0)]
    return spark.createDataFrame(data, "group_id STRING, decision STRING, epoch BIGINT, cost DOUBLE")


def test_g2_discount_and_schedule(spark):
    st = discount.discounted_state(discount.per_epoch_totals(_g2_updates(spark)), 0.5, last_epoch=3)
    assert rows(st, "epoch", "decision", "score_sum", "cnt") == [
        (1, "a", -30.0, 2.0), (2, "a", -15.0, 1.0), (2, "b", -8.0, 1.0), (3, "a", -7.5, 0.5), (3, "b", -4.0, 0.5)]
    n = agg.effective_n(st)
    assert rows(n, "epoch", "n_eff") == [(1, 2), (2, 2), (3, 0)]
    sch = policies.ucb_schedule(st, 3, 0.5)
    assert rows(sch, "epoch", "schedule") == [(1, "a:a:a:"), (2, "b:a:b:"), (3, "b:b:a:")]


def test_g3_schedule(spark):
    st = spark.createDataFrame([("g", 0, "a", -12.0, 4.0), ("g", 0, "b", -3.75, 1.5)],
                               "group_id STRING, epoch BIGINT, decision STRING, score_sum DOUBLE, cnt DOUBLE")
    sch = policies.ucb_schedule(st, 5, 0.9)
    assert rows(sch, "n_eff", "schedule") == [(5, "b:b:b:a:b:")]


def test_g4_reset(spark):
    data = [("g1", "a", 0, 1.0), ("g2", "a", 0, 1.0), ("g1", "a", 16, 1.0)]
    upd = spark.createDataFrame(data, "group_id STRING, decision STRING, epoch BIGINT, cost DOUBLE")
    st = discount.discounted_state(discount.per_epoch_totals(upd), 0.5, last_epoch=17, reset_period=15)
    sch = policies.ucb_schedule(st, 2, 0.5)
    out = sch.select("group_id", "epoch", policies.reset_payload(F.col("schedule"), F.col("epoch"), 15).alias("p"))
    got = {(g, e): p for g, e, p in out.collect()}
    assert all(got[("g2", e)] == "a:a:" for e in range(14))
    assert got[("g1", 14)] == "random" and got[("g2", 14)] == "random"
    assert ("g2", 15) not in got and ("g1", 15) not in got   # fresh segment, no data yet
    assert got[("g1", 16)] == "a:a:" and ("g2", 16) not in got


def test_g5_greedy(spark):
    t = spark.createDataFrame([("g", "a", -15.0), ("g", "b", -8.0), ("g", "c", -9.0), ("h", "y", 1.0), ("h", "x", 1.0)],
                              "group_id STRING, decision STRING, mean_score DOUBLE")
    b = {r["group_id"]: (r["best"], r["others"]) for r in policies.best_arm(t).collect()}
    assert b["g"] == ("b", ["a", "c"])
    assert b["h"] == ("x", ["y"])


G6_TREE = ('{"Field":"6","Table":[{"Key":"US","Rule":{"Field":"9","Table":[{"Key":"ios","Rule":{"GroupName":"G1"}}]}},'
           '{"Key":"US","Rule":{"GroupName":"G2"}},'
           '{"Key":"US","Rule":{"Field":"4","Table":[{"Key":"7018","Rule":{"GroupName":"G3"}}]}}]}')


def _features(f6, f9, f4):
    f = [""] * 17
    f[6], f[9], f[4] = f6, f9, f4
    return f


def test_g6_rules(spark):
    import arbiter.functions.rules as rules
    paths = flatten_rules(spark.createDataFrame([(1, G6_TREE)], "doc_id INT, rules STRING"))
    assert paths.count() == 3
    df = spark.createDataFrame([(1, _features("US", "ios", "1")), (2, _features("US", "ios", "7018")),
                                (3, _features("FR", "ios", "1"))], "id INT, features ARRAY<STRING>")
    g = rules.assign_groups(df, "features", paths)
    g = g.select("id", P.default_group("rule_group", "features", "asn").alias("asn"),
                 P.default_group("rule_group", "features", "null").alias("nul"),
                 P.default_group("rule_group", "features", "asn", precedence="default").alias("eg"))
    assert rows(g, "id", "asn", "nul", "eg") == [(1, "G2", "G2", "1"), (2, "G3", "G3", "7018"), (3, "1", "null", "1")]


def test_g7_routing(spark):
    table = spark.createDataFrame([("g1", "c1"), ("g2", "c2")], "group_name STRING, cluster STRING")
    upd = spark.createDataFrame([("g1", "x\t1"), ("g2", "x\t2"), ("g9", "x\t3")], "group_id STRING, update STRING")
    r = routing.route(upd, table, "c1")
    assert rows(r, "group_id", "topic", "cluster_id") == [
        ("g1", "internal_groups", "c1"), ("g2", "external_groups", "c2"), ("g9", "internal_groups", "c1")]


def test_g8_fanout(spark):
    reg = spark.createDataFrame([("g1", "c1"), ("g1", "c2"), ("g1", "c3"), ("g1", "c2")], "group_id STRING, cluster_id STRING")
    dec = spark.createDataFrame([("g1", "g1;a:;From: x"), ("g7", "g7;b:;From: x")], "group_id STRING, value STRING")
    out = routing.fan_out(dec, reg, "c1")
    assert rows(out, "cluster_id", "value") == [("c2", "g1;a:;From: x"), ("c3", "g1;a:;From: x")]
    merged = routing.merge_subscribers(reg, spark.createDataFrame([("g1", "c2")], "group_id STRING, cluster_id STRING"))
    assert merged.collect()[0]["subscribers"] == ["c1", "c2", "c3"]


def test_g9_weighted(spark):
    w = spark.createDataFrame([("g", 0, "a", 0.5), ("g", 1, "b", 0.3), ("g", 2, "c", 0.1)],
                              "group_id STRING, ord INT, name STRING, weight DOUBLE")
    t = serving.weight_table(w)
    req = spark.createDataFrame([(u,) for u in (0, 50, 51, 80, 81, 95)], "u INT").withColumn("group_id", F.lit("g"))
    out = req.join(t, "group_id").select("u", serving.weighted_pick("cum_weights", F.col("u")).alias("d"))
    assert dict(rows(out, "u", "d")) == {0: "a", 50: "a", 51: "b", 80: "b", 81: "c", 95: "c"}


def test_g10_epsilon(spark):
    req = spark.createDataFrame([(5,), (10,), (50,)], "u INT")
    eps = F.lit(0.1).cast("decimal(12,6)")
    res = {}
    for mode in ("lt", "gt"):
        p = serving.epsilon_pick(F.lit("best"), F.array(F.lit("other")), eps, F.col("u"), F.lit(0), explore_when=mode)
        res[mode] = dict(rows(req.select("u", p["decision"].alias("decision")), "u", "decision"))
    assert res["lt"] == {5: "other", 10: "best", 50: "best"}
    assert res["gt"] == {5: "best", 10: "best", 50: "other"}
    one = serving.epsilon_pick(F.lit("best"), F.array().cast("array<string>"), eps, F.col("u"), F.lit(0), "lt")
    assert {r[0] for r in req.select(one["decision"]).collect()} == {"best"}   # C6


def test_g11_load(spark):
    recs = spark.createDataFrame([(0, i, d, True) for i, d in enumerate("abaa")], "minute INT, ts_ms INT, chosen STRING, offered BOOLEAN") \
        .withColumn("line_no", F.col("ts_ms"))
    s = traces.load_share(recs)
    assert [r["load"] for r in s.orderBy("ts_ms").collect()] == [0.25, 0.25, 0.5, 0.75]
    # a session whose decision isn't on offer counts in the minute, but not as load
    recs = spark.createDataFrame([(0, i, d, ok) for i, (d, ok) in enumerate([("a", True), ("a", False), ("a", True), (None, False)])],
                                 "minute INT, ts_ms INT, chosen STRING, offered BOOLEAN").withColumn("line_no", F.col("ts_ms"))
    got = [(r["running"], r["minute_total"], r["load"]) for r in traces.load_share(recs).orderBy("ts_ms").collect()]
    assert got == [(1, 4, 0.25), (None, 4, None), (2, 4, 0.5), (None, 4, None)]
    curve = F.array(F.struct(F.lit(0.2).alias("threshold"), F.lit(1.5).alias("factor")),
                    F.struct(F.lit(0.5).alias("threshold"), F.lit(2.0).alias("factor")))
    loads = spark.createDataFrame([(0.1,), (0.2,), (0.4,), (0.75,)], "load DOUBLE")
    assert dict(rows(loads.select("load", traces.step_factor(curve, "load").alias("f")), "load", "f")) == {
        0.1: 1.0, 0.2: 1.0, 0.4: 1.5, 0.75: 2.0}


def test_g12_blocks(spark):
    s = with_ordinal(spark.createDataFrame([(float(v),) for v in range(1, 151)], "value DOUBLE"), ["value"],)
    assert rows(series.block_means(s, "ord", "value", 60), "label", "mean_value") == [(60, 30.5), (120, 90.5)]
    a = spark.range(250).withColumn("src", F.lit("a"))
    b = spark.range(410).withColumn("src", F.lit("b"))
    ba = series.block_means(a.withColumn("v", F.lit(1.0)), "id", "v", 100)
    bb = series.block_means(b.withColumn("v", F.lit(1.0)), "id", "v", 100)
    assert series.zip_series(ba, bb).count() == 2
    assert rows(series.length_gap(ba, bb), "n_a", "n_b", "gap") == [(2, 4, 2)]


def test_g13_latency(spark):
    o = spark.createDataFrame([(0, 100000), (500000, 300000), (1000000, 200000), (2500000, 400000)],
                              "sent_us BIGINT, rt_us BIGINT")
    s = series.latency_series(o, "sent_us", "rt_us", 0)
    got = rows(s, "sec", "mean_rt", "n")
    assert [(a, round(b, 9), c) for a, b, c in got] == [(0, 0.2, 3), (1, 0.0, 0), (2, 0.4, 1)]


def test_g14_cdf_p90(spark):
    v = spark.createDataFrame([(i, i) for i in range(1, 11)], "v INT, id INT")
    assert rows(series.cdf(v, "v", "id"), "pct") == [(p * 10.0,) for p in range(10)]
    assert rows(series.percentile_at(v, "v", 9, 10), "n", "p") == [(10, 10)]


def test_g15_failover(spark):
    r = spark.createDataFrame([(0, "online", 2.0), (0, "online", 4.0), (0, "local", 6.0)],
                              "sec INT, status STRING, cost DOUBLE")
    got = {s: (m, n) for s, m, n in traces.failover(r, "sec", "status").select("status", "mean_cost", "n").collect()}
    assert got == {"all": (4.0, 3), "online": (3.0, 2), "local": (6.0, 1)}


def test_failover_takes_the_third_decision(spark):
    r = spark.createDataFrame([
        (0, False, "a", {"a": 2.0, "b": 9.0, "c": 9.0}), (0, False, "x", {"a": 2.0}), (0, False, None, {"a": 2.0}),
        (0, True, "a", {"b": 1.0, "a": 2.0, "c": 6.0}), (0, True, "a", {"a": 2.0, "b": 1.0}), (1, True, "a", {"a": 1.0}),
    ], "sec INT, failed BOOLEAN, chosen STRING, decision_map MAP<STRING, DOUBLE>")
    assert rows(traces.failover_local(r), "sec", "status", "n", "n_cost", "mean_cost") == [
        (0, "all", 3, 2, 4.0), (0, "local", 2, 1, 6.0), (0, "online", 1, 1, 2.0), (1, "all", 1, 0, None), (1, "local", 1, 0, None)]


def test_latency_outcomes_ask_succeeded(spark, monkeypatch):
    from arbiter.plans import series as plans
    monkeypatch.setattr(plans, "succeeded", lambda result: F.lit(False))
    assert plans.latency_summary_q(spark, "/root/testdata/sf0.001").first()["n_ok"] == 0


def test_g16_gaps(spark):
    t = spark.createDataFrame([(0, 0), (1, 100000), (2, 300000)], "id INT, us BIGINT")
    g = series.gaps(with_ordinal(t, ["us", "id"]), "ord", "us")
    assert [r["gap"] for r in g.orderBy("ord").collect()] == [None, 0.1, 0.2]


def test_rule_flatten_edge_cases(spark):
    docs = [(1, '{"GroupName":"root"}'),
            (2, '{"Field":"1","Table":[]}'),
            (3, '{"Field":"1","GroupName":"ignored","Table":[{"Key":"a","Rule":{"Field":"2","Table":['
                '{"Key":"b","Rule":{"Field":"3","Table":[{"Key":"c","Rule":{"GroupName":"deep"}}]}},'
                '{"Key":"x","Rule":{"GroupName":"mid"}}]}},{"Key":"z","Rule":{"GroupName":"top"}}]}')]
    p = flatten_rules(spark.createDataFrame(docs, "doc_id INT, rules STRING"))
    got = sorted((r.doc_id, list(r.rule_order), [(x.field, x.key) for x in r.path], r.group_name) for r in p.collect())
    assert got == [(1, [], [], "root"),
                   (3, [0, 0, 0], [(1, "a"), (2, "b"), (3, "c")], "deep"),
                   (3, [0, 1], [(1, "a"), (2, "x")], "mid"),
                   (3, [1], [(1, "z")], "top")]


def test_rule_join_equals_case(spark):
    """Root leaves, repeated paths, null features and rows alike; the same as the rules read one by one."""
    from arbiter.functions.rules import rules_case
    rules = [([(1, "a")], "A"), ([(1, "a"), (2, "x")], "AX"), ([], "ROOT"), ([(2, "x")], "X"), ([(1, "a")], "A2"), ([(1, "b"), (2, "y")], "BY")]
    rows_ = [(i, [None if v == "-" else v for v in f]) for i, f in enumerate(
        [["0", "a", "x"], ["0", "a", "y"], ["0", "b", "y"], ["0", "c", "x"], ["0", "-", "x"], ["0", "b", "z"]])]
    df = spark.createDataFrame(rows_, "id INT, f ARRAY<STRING>")
    paths = spark.createDataFrame([([i], [(int(f), k) for f, k in path], g) for i, (path, g) in enumerate(rules)],
                                  "rule_order ARRAY<INT>, path ARRAY<STRUCT<field: INT, key: STRING>>, group_name STRING")
    got = assign_groups(df, "f", paths, "a").select("id", "a", rules_case(F.col("f"), rules).alias("b"))
    assert all(r.a == r.b for r in got.collect())
    assert dict(rows(got, "id", "a")) == {0: "A2", 1: "A2", 2: "BY", 3: "X", 4: "X", 5: "ROOT"}


def test_unknown_event_types_are_kept(spark, tmp_path):
    from arbiter import adapters as ad
    from arbiter.plans.routing import latest_decision_q
    from arbiter.plans.series import policy_pivot_q
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    odd = e.withColumn("event_type", F.when(F.col("event_id") % 2 == 0, "refund").otherwise(F.col("event_type")))
    odd.write.parquet(f"{tmp_path}/events.parquet")
    pivot = policy_pivot_q(spark, str(tmp_path)).where("feature_type = 'sessions'")
    kinds = [c for c in pivot.columns if c not in ("feature_type", "group_id", "i")]
    assert kinds == ["click", "error", "purchase", "refund", "signup", "view"]
    assert pivot.agg(F.sum(sum(F.coalesce(F.col(k), F.lit(0.0)) for k in kinds))).first()[0] == e.count()
    others = {r.others for r in latest_decision_q(spark, str(tmp_path)).collect()}
    assert all("refund" in o.split(",") for o in others if len(o.split(",")) == 5 and "click,error,purchase,signup,view" != o)
    assert "click,error,purchase,signup,view" in others
    assert all("refund" in r.payload for r in ad.request_payloads(odd).collect())
    with pytest.raises(ValueError):
        ad.event_types(odd.withColumn("event_type", F.lit(None).cast("string")))
