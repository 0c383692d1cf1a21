"""Stream = batch (G17): the streaming forms give the batch results, also across a restart."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from arbiter import adapters as ad
from arbiter.operators import discount, policies
from arbiter.sources.topics import read_topic
from arbiter.streaming.communicator import Communicator
from arbiter.streaming.decisions import DecisionStream
from arbiter.streaming.windows import sliding_stream

SF = "/root/testdata/sf0.001"


def _chunks(base, parts, first=0):
    """One Parquet file per micro-batch; the file source takes files in order of their times."""
    for i, part in enumerate(parts, first):
        p = os.path.join(base, "in", f"chunk={i}")
        part.coalesce(1).write.parquet(p)
        for f in os.listdir(p):
            os.utime(os.path.join(p, f), (1_700_000_000 + i, 1_700_000_000 + i))


def _read_chunks(spark, base, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in", "chunk=*"))


def _epoch_updates(spark):
    return ad.updates(ad.table(spark, SF, "events")).select("ts", "group_id", "decision", "cost", "epoch")


def _closed(upd):
    """The last epoch whose end the watermark (the latest time) has passed."""
    last = upd.agg(F.max(F.floor(F.unix_micros("ts") / 1000))).first()[0]
    return (last * 1000 - ad.EPOCH_BASE_US) // ad.EPOCH_WIDTH_US - 1


def _same_as_batch(ds, upd, closed, gamma=0.5, picks=5, reset=None):
    st = discount.discounted_state(discount.per_epoch_totals(upd.where(F.col("epoch") <= closed)), gamma, closed, reset_period=reset)
    keys = ["group_id", "decision", "epoch", "score_sum", "cnt"]
    assert sorted(ds.state_rows().select(*keys).collect()) == sorted(st.select(*keys).collect())
    payload = policies.reset_payload(F.col("schedule"), F.col("epoch"), reset) if reset else F.col("schedule")
    want = policies.ucb_schedule(st, picks, gamma).select("epoch", "group_id", payload.alias("payload"))
    assert sorted(ds.decisions().select("epoch", "group_id", "payload").collect()) == sorted(want.collect())


@pytest.mark.parametrize("reset,first", [(None, 40), (15, 1)])
def test_decision_stream_equals_batch_with_restart(spark, reset, first):
    """A silent stretch of thirty epochs, a restart after the first batch, one late row."""
    base = tempfile.mkdtemp(prefix="arbiter-stream-")
    upd = _epoch_updates(spark).where("epoch < 50 or epoch >= 80")
    ds = DecisionStream(spark, os.path.join(base, "out"), gamma=0.5, picks=5, origin="b1:9092", reset_period=reset)
    _chunks(base, [upd.where(F.col("epoch") < first)])
    ds.start(_read_chunks(spark, base, upd.schema), os.path.join(base, "cp")).awaitTermination()
    assert 0 <= ds.state_rows().agg(F.max("epoch")).first()[0] < first if first > 1 else True
    late = upd.where(F.col("epoch") == 0).limit(1)
    _chunks(base, [upd.where((F.col("epoch") >= first) & (F.col("epoch") < 50)),
                   upd.where(F.col("epoch") >= 80).unionByName(late)], first=1)
    ds.start(_read_chunks(spark, base, upd.schema), os.path.join(base, "cp")).awaitTermination()
    closed = _closed(upd)
    _same_as_batch(ds, upd, closed, reset=reset)
    silent = ds.state_rows().where("epoch between 50 and 79")
    assert silent.select("epoch").distinct().count() == (30 if reset is None else 10)   # a reset leaves nothing to decay
    assert [(r.epoch, r.cost) for r in ds.late_rows().collect()] == [(0, late.first().cost)]


def test_heartbeats_go_on_without_input(spark):
    import time
    from arbiter.streaming.decisions import heartbeats
    base = tempfile.mkdtemp(prefix="arbiter-beat-")
    os.makedirs(os.path.join(base, "in"))
    with open(os.path.join(base, "in", "a.txt"), "w") as f:
        f.write("c1\nc1\nc2\n")
    stream = spark.readStream.text(os.path.join(base, "in")).select(F.col("value").alias("cluster_id"))
    q = (heartbeats(stream, 500).writeStream.outputMode("append").format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "cp")).trigger(processingTime="500 milliseconds").start())
    beats = []
    for _ in range(120):
        time.sleep(0.5)
        beats = spark.read.schema("cluster_id string, beat long, at_ms long, n_records long").parquet(os.path.join(base, "out")).collect() \
            if os.path.isdir(os.path.join(base, "out", "_spark_metadata")) else []
        if sum(r.cluster_id == "c2" for r in beats) >= 3:
            break
    q.stop()
    for c, n in (("c1", 2), ("c2", 1)):
        mine = sorted((r.beat, r.at_ms, r.n_records) for r in beats if r.cluster_id == c)
        assert len(mine) >= 3 and [b for b, _, _ in mine] == list(range(len(mine)))
        assert [x for _, _, x in mine] == [n] + [0] * (len(mine) - 1)
        assert all(b - a >= 500 for (_, a, _), (_, b, _) in zip(mine, mine[1:]))


def test_sliding_stream_equals_batch(spark):
    """A row far ahead closes every window; state rows are panes and windows of arms, not rows times windows."""
    from arbiter.operators.aggregates import sliding_arm_totals
    base = tempfile.mkdtemp(prefix="arbiter-win-")
    upd = ad.updates(ad.table(spark, SF, "events")).select("ts", "group_id", "decision", "cost")
    ahead = upd.limit(1).withColumn("ts", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    _chunks(base, [*(upd.where(F.dayofmonth("ts") % 3 == k) for k in range(3)), ahead])
    q = (sliding_stream(_read_chunks(spark, base, upd.schema), "6 hours", "1 hour", "100 days").writeStream.outputMode("append")
         .format("memory").queryName("win_test").option("checkpointLocation", os.path.join(base, "cp"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("win_test")
    want = sliding_arm_totals(upd, "6 hours", "1 hour")
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    most = max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"])
    panes = upd.select(F.date_trunc("hour", "ts"), "group_id", "decision").distinct().count()
    assert most <= max(panes + 1, want.count())


def test_communicator_flows(spark):
    base = tempfile.mkdtemp(prefix="arbiter-comm-")
    topics = os.path.join(base, "topics")
    files = {
        "subscribe": ["g1;c2", "g1;c3", "g1;c2", "g2;c1"],
        "decision": ["g1;a:;From: x", "g7;b:;From: x"],
        "external_groups": ['{"update":"a\\t1.5","group_id":"g5","cluster_id":"c4"}',
                            '{"update":"b\\t2.5","group_id":"g5","cluster_id":"c4"}'],
        "upload": ["\t".join(str(i % 3) for i in range(17)) for _ in range(300)],
    }
    for t, lines in files.items():
        os.makedirs(os.path.join(topics, t))
        with open(os.path.join(topics, t, "part-0.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
    c = Communicator(spark, os.path.join(base, "state"), own="c1", sample_fraction=0.1)
    sub = read_topic(spark, "subscribe", fmt="text", root=topics)
    cp = os.path.join(base, "cp")
    # the registry must exist before decisions are fanned out: subscriptions first
    q = c.subscriptions(sub).writeStream.option("checkpointLocation", f"{cp}/s").format("parquet") \
        .trigger(availableNow=True).start(c.registry_path)
    q.awaitTermination()
    assert sorted(tuple(r) for r in c.registry().collect()) == [("g1", "c2"), ("g1", "c3"), ("g2", "c1")]
    for name, fn in (("decision", c.decision_batch), ("external_groups", c.external_batch), ("upload", c.upload_batch)):
        read_topic(spark, name, fmt="text", root=topics).writeStream.option("checkpointLocation", f"{cp}/{name}") \
            .foreachBatch(fn).trigger(availableNow=True).start().awaitTermination()
    parts = [spark.read.text(os.path.join(base, "state", "outbox", f)).select("dest_cluster", "topic", "value")
             for f in ("decision", "external")]
    out = parts[0].unionByName(parts[1])
    dec = sorted(tuple(r) for r in out.where("topic = 'decision'").collect())
    assert dec == [("c2", "decision", "g1;a:;From: x"), ("c3", "decision", "g1;a:;From: x")]
    assert out.where("topic = 'internal_groups' AND dest_cluster = 'c4'").count() == 2
    assert [tuple(r) for r in out.where("topic = 'subscribe'").select("dest_cluster", "value").collect()] == [("c4", "g5;c1")]
    alive = spark.read.parquet(os.path.join(base, "state", "alive"))
    assert alive.count() >= 1
    counts = spark.read.parquet(os.path.join(base, "state", "sample"))
    assert counts.agg(F.sum("n")).first()[0] % 15 == 0   # every sampled row contributes 15 feature pairs


def test_warm_start_is_the_initial_state(spark):
    """120 historic updates per group count in epoch 0, also when the first epochs are silent and after a restart."""
    base = tempfile.mkdtemp(prefix="arbiter-seed-")
    upd = _epoch_updates(spark).where("epoch >= 3")
    seed = spark.createDataFrame([("0", "view", 0, 1000.25 * 120, 120), ("new", "click", 1, 7.5, 2)],
                                 "group_id STRING, decision STRING, epoch BIGINT, cost DOUBLE, n BIGINT")
    ds = DecisionStream(spark, os.path.join(base, "out"), gamma=0.5, picks=3, origin="o", seed=seed)
    for i, part in enumerate((upd.where("epoch < 60"), upd.where("epoch >= 60"))):
        _chunks(base, [part], first=i)
        ds.start(_read_chunks(spark, base, upd.schema), os.path.join(base, "cp")).awaitTermination()
    closed = _closed(upd)
    totals = discount.per_epoch_totals(upd.where(F.col("epoch") <= closed)).unionByName(
        seed.select("group_id", "decision", "epoch", (-F.col("cost")).alias("xs"), F.col("n").cast("double").alias("xc")))
    st = discount.discounted_state(totals, 0.5, closed)
    keys = ["group_id", "decision", "epoch", "score_sum", "cnt"]
    got = ds.state_rows().select(*keys).collect()
    assert sorted(got) == sorted(st.select(*keys).collect())
    assert {(r.epoch, r.cnt) for r in got if r.group_id == "0" and r.decision == "view" and r.epoch < 3} == {(0, 120.0), (1, 60.0), (2, 30.0)}


def test_drain_counts(spark):
    from arbiter.streaming.metrics import count_per_batch, drain_counts
    base = tempfile.mkdtemp(prefix="arbiter-drain-")
    upd = _epoch_updates(spark)
    _chunks(base, [upd.where(F.col("epoch") == e) for e in range(3)])
    q = _read_chunks(spark, base, upd.schema).writeStream.option("checkpointLocation", os.path.join(base, "cp3")).foreachBatch(
        count_per_batch(os.path.join(base, "drains"))).trigger(availableNow=True).start()
    q.awaitTermination()
    n = sorted(tuple(r) for r in spark.read.parquet(os.path.join(base, "drains")).select("batch_id", "n_records").collect())
    assert [b for b, _ in n] == [0, 1, 2]
    assert sum(c for _, c in n) == sum(r.num_input_rows for r in drain_counts(spark, q).collect())


def test_topic_sink_routes_by_column_and_four_flows_start(spark):
    from arbiter.sources.topics import write_topic
    base = tempfile.mkdtemp(prefix="arbiter-topics-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "m.txt"), "w") as f:
        f.write("internal_groups|a\nexternal_groups|b\ninternal_groups|c\n")
    s = spark.readStream.text(src).select(F.split("value", r"\|").getItem(0).alias("topic"),
                                          F.split("value", r"\|").getItem(1).alias("value"))
    write_topic(s, os.path.join(base, "cp"), fmt="text", root=os.path.join(base, "bus")).awaitTermination()
    bus = spark.read.text(os.path.join(base, "bus"))
    assert sorted((r.topic, r.value) for r in bus.collect()) == [
        ("external_groups", "b"), ("internal_groups", "a"), ("internal_groups", "c")]

    # the four communicator flows started together (T7) over their own topic folders
    topics = os.path.join(base, "topics")
    for t, line in (("upload", "\t".join("x" * 17)), ("subscribe", "g1;c2"), ("decision", "g1;a:;From: x"),
                    ("external_groups", '{"update":"a\\t1","group_id":"g5","cluster_id":"c4"}')):
        os.makedirs(os.path.join(topics, t))
        with open(os.path.join(topics, t, "p.txt"), "w") as f:
            f.write(line + "\n")
    c = Communicator(spark, os.path.join(base, "state"), own="c1")
    qs = c.start(*(read_topic(spark, t, fmt="text", root=topics) for t in ("upload", "subscribe", "decision", "external_groups")),
                 checkpoint=os.path.join(base, "cp4"))
    for q in qs:
        q.awaitTermination()
    assert [tuple(r) for r in c.registry().collect()] == [("g1", "c2")]
    fwd = spark.read.text(os.path.join(base, "state", "outbox", "external"))
    assert fwd.where("topic = 'internal_groups' AND dest_cluster = 'c4'").count() == 1


def test_sliding_stream_append_mode_drops_late_rows(spark):
    from arbiter.operators.aggregates import sliding_arm_totals
    base = tempfile.mkdtemp(prefix="arbiter-wm-")
    upd = ad.updates(ad.table(spark, SF, "events")).select("event_id", "ts", "group_id", "decision", "cost")
    cut = F.lit("2024-01-18 00:00:00").cast("timestamp")          # ~60 % of the 30 days
    early = upd.where(F.col("ts") <= cut)
    late_row = upd.orderBy("ts").limit(1).withColumn("event_id", F.lit(-1).cast("bigint"))   # day-one row, re-sent late
    # the late copy comes in a third batch, after its windows were closed and emitted
    for i, part in enumerate((early, upd.where(F.col("ts") > cut), late_row)):
        p = os.path.join(base, "in", f"chunk={i}")
        part.coalesce(1).write.parquet(p)
        for f in os.listdir(p):
            os.utime(os.path.join(p, f), (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(upd.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in", "chunk=*"))
    q = (sliding_stream(stream.drop("event_id"), "6 hours", "1 hour", "1 day").writeStream.outputMode("append")
         .format("memory").queryName("wm_test").option("checkpointLocation", os.path.join(base, "cp"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("wm_test")
    max_s = upd.agg(F.max(F.unix_micros("ts"))).first()[0] / 1e6
    want = sliding_arm_totals(upd, "6 hours", "1 hour").where(F.col("window_end") <= max_s - 86400)
    assert got.count() > 0
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())   # late copy not counted
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1   # one late row, of one pane


@pytest.mark.parametrize("warm", [False, True])
def test_epsilon_greedy_stream_equals_batch(spark, warm):
    from arbiter.operators.aggregates import guarded_mean, sliding_arm_totals
    from arbiter.sources.seeds import warm_start_rows
    from arbiter.streaming.windows import EpsilonGreedyStream
    base = tempfile.mkdtemp(prefix="arbiter-eg-")
    upd = ad.updates(ad.table(spark, SF, "events")).select("event_id", "ts", "group_id", "decision", "cost")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp")
    for i, part in enumerate((upd.where(F.col("ts") < cut), upd.where(F.col("ts") >= cut))):
        p = os.path.join(base, "in", f"chunk={i}")
        part.coalesce(1).write.parquet(p)
        for f in os.listdir(p):
            os.utime(os.path.join(p, f), (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(upd.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in", "chunk=*"))
    rows = warm_start_rows(upd, 120)
    es = EpsilonGreedyStream(spark, os.path.join(base, "out"), 0.1, "b1:9092", "6 hours", "1 hour", "1 day",
                             seed=rows.where("weight > 1") if warm else None)
    es.start(stream.drop("event_id"), os.path.join(base, "cp")).awaitTermination()
    totals = sliding_arm_totals(rows if warm else rows.where("weight = 1"), "6 hours", "1 hour", weight="weight")
    last = upd.agg(F.max(F.unix_micros("ts"))).first()[0] / 1e6
    totals = totals.where(F.col("window_end") <= last - 86400).withColumn("mean_score", guarded_mean("score_sum", "cnt"))
    best = policies.best_arm(totals, keys=("window_start", "group_id"))
    want = best.select("window_start", "group_id", "best", policies.eg_message(best, 0.1, "b1:9092").alias("message"))
    got = es.decisions().select("window_start", "group_id", "best", "message")
    assert got.count() > 100 and sorted(got.collect()) == sorted(want.collect())


def test_group_table_messages(spark):
    from arbiter.operators.routing import group_table, latest_rules
    msgs = ['{"GroupAssignment":[{"GroupName":"g1","Cluster":"c1"},{"GroupName":"g2","Cluster":"c1"},{"GroupName":"g1","Cluster":"c3"}]}',
            '{"GroupingRules":{"Field":"6","Table":[{"Key":"US","Rule":{"GroupName":"G"}}]}}', "not json",
            '{"GroupAssignment":[{"GroupName":"g2","Cluster":"c2"}],"GroupingRules":{"GroupName":"all"}}']
    df = spark.createDataFrame(list(enumerate(msgs)), "offset BIGINT, value STRING")
    assert sorted(map(tuple, group_table(df).collect())) == [("g1", "c3", 0), ("g2", "c2", 3)]
    assert [tuple(r) for r in latest_rules(df).collect()] == [('{"GroupName":"all"}', 3)]
    assert latest_rules(df.where("offset = 0")).count() == 0


def test_two_clusters_pass_no_decision_round(spark):
    base = tempfile.mkdtemp(prefix="arbiter-loop-")
    own = {}
    for c, other in (("c1", "c2"), ("c2", "c1")):
        own[c] = Communicator(spark, os.path.join(base, c), own=c, origin=f"b-{c}")
        spark.createDataFrame([("g1", other), ("g1", c)], "group_id STRING, cluster_id STRING").write.parquet(own[c].registry_path)
    first = spark.createDataFrame([("g1;a:;From: b-c1",)], "value STRING")
    own["c1"].decision_batch(first, 0)
    sent = spark.read.text(os.path.join(base, "c1", "outbox", "decision")).where("dest_cluster = 'c2'").select("value")
    assert [r.value for r in sent.collect()] == ["g1;a:;From: b-c1"]
    own["c2"].decision_batch(sent, 0)
    out = os.path.join(base, "c2", "outbox", "decision", "batch_id=0")
    assert not [f for f in os.listdir(out) if f.startswith("dest_cluster")]


@pytest.mark.parametrize("cuts", [1, 7])
def test_arrival_stream_equals_batch(spark, cuts):
    from arbiter.operators.ordinal import with_ordinal
    from arbiter.operators.series import ack_blocks, gaps
    from arbiter.streaming.arrivals import arrivals
    base = tempfile.mkdtemp(prefix="arbiter-arr-")
    e = ad.table(spark, SF, "events").select(F.lit("all").alias("source"), F.col("event_id").alias("id"), ad.ts_micros("ts").alias("ts_us"))
    low, high = e.agg(F.min("ts_us"), F.max("ts_us")).first()
    part = F.least(F.lit(cuts - 1), F.floor((F.col("ts_us") - low) * cuts / (high - low + 1)))
    _chunks(base, [e.where(part == k) for k in range(cuts)])
    q = (arrivals(_read_chunks(spark, base, e.schema), 10).writeStream.outputMode("append").format("parquet")
         .option("path", os.path.join(base, "out")).option("checkpointLocation", os.path.join(base, "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(base, "out"))
    by_time = with_ordinal(e, ["ts_us", "id"])
    assert sorted((r.id, r.secs) for r in got.where("kind = 'gap'").collect()) == sorted(
        (r.id, r.gap) for r in gaps(by_time, "ord", "ts_us").where("gap is not null").collect())
    assert sorted((r.total, r.secs) for r in got.where("kind = 'block'").collect()) == sorted(
        map(tuple, ack_blocks(by_time, "ord", "ts_us", 10).collect()))


def test_one_broker_per_destination(spark):
    base = tempfile.mkdtemp(prefix="arbiter-brokers-")
    brokers = {c: {"format": "text", "path": os.path.join(base, c)} for c in ("c2", "c3")}
    c = Communicator(spark, os.path.join(base, "own"), own="c1", brokers=brokers)
    spark.createDataFrame([("g1", "c2"), ("g1", "c3"), ("g1", "c9"), ("g2", "c3")], "group_id STRING, cluster_id STRING").write.parquet(c.registry_path)
    batch = spark.createDataFrame([("g1;a:;From: x",), ("g2;b:;From: x",)], "value STRING")
    for _ in range(2):  # a replayed batch
        c.decision_batch(batch, 0)
    sent = {k: sorted(r.value for r in spark.read.text(os.path.join(base, k, "batch_id=0", "topic=decision")).collect()) for k in ("c2", "c3")}
    assert sent == {"c2": ["g1;a:;From: x"], "c3": ["g1;a:;From: x", "g2;b:;From: x"]}
    dead = spark.read.parquet(os.path.join(base, "own", "dead", "decision"))
    assert [(r.dest_cluster, r.topic, r.value) for r in dead.collect()] == [("c9", "decision", "g1;a:;From: x")]
