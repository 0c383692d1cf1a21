"""As-of lookup against a plain scan; learning policies against a plain replay and the Catalyst schedule."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from arbiter.operators import learning as L
from arbiter.operators import policies
from arbiter.operators.asof import as_of


def plain_as_of(rows, entries):
    out = []
    for i, k, t in rows:
        mine = [(s, tie, v) for kk, s, tie, v in entries if kk is not None and s is not None and kk == k and t is not None and s <= t]
        out.append((i, k, t, max(mine)[2] if mine else None))
    return out


def test_as_of_hot_key_ties_and_nulls(spark):
    rng = random.Random(3)
    keys = ["hot"] * 12 + ["a", "b", "only rows", None]
    rows = [(i, rng.choice(keys), rng.choice([None, *range(40)])) for i in range(600)]
    rows += [(1000 + i, "hot", 17) for i in range(300)]                       # a hot instant
    entries = [(rng.choice(["hot", "hot", "a", "b", "only entries", None]), rng.choice([None, *range(0, 40, 3)]), n, f"v{n}") for n in range(200)]
    entries = [(k, s, n, None if n % 7 == 0 else v) for k, s, n, v in entries]  # an entry may hold nulls
    left = spark.createDataFrame([(*r, "old") for r in rows], "id LONG, k STRING, t LONG, v STRING")
    right = spark.createDataFrame(entries, "k STRING, since LONG, tie LONG, v STRING")
    for n in (1, 7, 64):
        got = as_of(left, right, "k", "t", "since", ["v"], "tie", partitions=n)
        assert got.columns == ["id", "k", "t", "v"]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_as_of(rows, entries)))


def test_as_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", 5)], "id LONG, k STRING, t LONG")
    right = spark.createDataFrame([("a", 5, "x")], "k STRING, since LONG, v STRING")
    assert [tuple(r) for r in as_of(left, right, "k", "t", "since", ["v"]).collect()] == [(1, "a", 5, "x")]
    assert [tuple(r) for r in as_of(left, right.limit(0), "k", "t", "since", ["v"]).collect()] == [(1, "a", 5, None)]
    assert as_of(left.limit(0), right, "k", "t", "since", ["v"]).collect() == []


def test_as_of_plan_has_no_inequality_join(spark):
    left = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    right = spark.range(50).select((F.col("id") % 3).alias("k"), F.col("id").alias("since"), F.col("id").alias("v"))
    plan = as_of(left, right, "k", "t", "since", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_schedule_equals_catalyst(spark):
    rng = random.Random(1)
    states = [{d: (-rng.uniform(0, 90), rng.choice([0.0, 0.25, 1.0, 7.5, 300.0])) for d in rng.sample("abcdef", rng.randint(1, 6))}
              for _ in range(80)]
    df = spark.createDataFrame([(str(g), 0, d, s, c) for g, st in enumerate(states) for d, (s, c) in st.items()],
                               "group_id STRING, epoch LONG, decision STRING, score_sum DOUBLE, cnt DOUBLE")
    want = {r.group_id: r.schedule for r in policies.ucb_schedule(df, 6, 0.5).collect()}
    assert {str(g): ":".join(L.Ucb(6, 0.5).slots(st)) + ":" for g, st in enumerate(states)} == want


def replay(rows, policy):
    """Request by request: {line: (chosen, from_policy, cost)}."""
    out = {}
    for group in {g for _, g, _, _ in rows}:
        mine = [r for r in rows if r[1] == group]
        epochs = [e for _, _, e, _ in mine]
        state = policy.start()
        for epoch in range(min(epochs), max(epochs) + 1):
            slots, new = policy.slots(state), {}
            for line, _, _, offer in (r for r in mine if r[2] == epoch):
                if not offer:
                    out[line] = (None, False, None)
                    continue
                pick = slots[line % policy.n_slots] if slots else None
                keys = list(offer)
                got = pick if pick in offer else keys[line // 7 % len(keys)]
                out[line] = (got, pick in offer, offer[got])
                s, n = new.get(got, (Decimal(0), 0))
                new[got] = (s - Decimal(str(offer[got])), n + 1)
            state = policy.learn(state, epoch, {d: (float(s), float(n)) for d, (s, n) in new.items()})
    return out


def trace(rng, n):
    """Requests of three groups (one without a name) with gaps between epochs; some offer one option or nothing."""
    rows = []
    for line in range(n):
        offer = {d: round(rng.uniform(1, 50), 2) for d in sorted(rng.sample("wxyz", rng.choice((0, 1, 2, 3, 4, 4))))}
        rows.append((line, rng.choice(["g", "g", "h", None]), rng.choice([2, 3, 4, 9, 10, 11, 30]), offer))
    return rows


def table(spark, rows):
    """The maps keep the order in which the options are listed."""
    listed = [(line, g, e, list(offer.items())) for line, g, e, offer in rows]
    df = spark.createDataFrame(listed, "line_no LONG, group_id STRING, epoch LONG, o ARRAY<STRUCT<k:STRING,v:DOUBLE>>")
    return df.select("line_no", "group_id", "epoch", F.map_from_entries("o").alias("decision_map"))


def test_learning_equals_a_replay(spark):
    rng = random.Random(7)
    rows = trace(rng, 700)
    df = table(spark, rows)
    for policy in (L.Ucb(5, 0.5), L.Ucb(3, 0.75, reset=4), L.EpsilonGreedy(0.2, 3), L.Weighted(0.5)):
        got = {r.line_no: (r.chosen, r.from_policy, r.cost) for r in L.evaluate_learning(df, policy).collect()}
        assert got == replay(rows, policy)
        assert sum(f for _, f, _ in got.values()) > 100


def test_learning_from_nothing(spark):
    empty = table(spark, [])
    assert L.evaluate_learning(empty, L.Ucb(5, 0.5)).collect() == []
    r = L.evaluate_learning(table(spark, [(1, "g", 0, {})]), L.Weighted(0.5)).first()
    assert (r.chosen, r.cost, r.from_policy) == (None, None, False)


def test_few_rows_over_a_wide_estimate_are_broadcast(spark):
    """the policy has a row per group, but its estimate is that of the joins below; the records aren't shuffled by group."""
    from arbiter.operators.joins import counted_small
    wide = spark.range(200_000)
    few = wide.join(wide.withColumnRenamed("id", "k"), F.col("id") == F.col("k")).groupBy((F.col("id") % 5).alias("g")).count()
    rows = spark.range(1000).select((F.col("id") % 5).alias("g"))
    joined = rows.join(counted_small(few), "g", "left")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("count = 40000").count() == 1000
    assert counted_small(few, rows=4).hint("merge").count() == 5  # a larger copy comes back whole


def test_alignment_parses_once_and_shares_totals(spark, monkeypatch):
    """one trace and one table of totals per number of slots feed all policies."""
    from arbiter.operators import traces as T
    from arbiter.plans import learning as P
    seen = {"parse": 0, "totals": []}
    parse, what_if = T.parse_trace, L.what_if
    monkeypatch.setattr(T, "parse_trace", lambda *a, **k: (seen.update(parse=seen["parse"] + 1), parse(*a, **k))[1])
    monkeypatch.setattr(L, "what_if", lambda r, n, *a, **k: (seen["totals"].append(n), what_if(r, n, *a, **k))[1])
    P.policy_alignment_q(spark, "/root/testdata/sf0.001")
    assert seen["parse"] == 1
    assert sorted(seen["totals"]) == sorted({p.n_slots for p in P.POLICIES.values()})
