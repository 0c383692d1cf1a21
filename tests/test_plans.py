"""Physical-plan properties the design relies on (read from the executed plans)."""

from pyspark.sql import functions as F

from arbiter.operators.joins import small
from arbiter.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruned_and_aggregate_partial(spark):
    p = plan(QUERIES["arm_totals"](spark, SF))
    read_schema = p.split("ReadSchema:")[1].split("\n")[0]
    assert "props" not in read_schema and "event_id" not in read_schema     # unused columns are not read
    assert "partial_sum" in p and "partial_count" in p                      # map-side combine before the shuffle


def test_dimension_lookup_is_broadcast_after_size_check(spark):
    p = plan(QUERIES["route_updates"](spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_small_refuses_large_side(spark, monkeypatch):
    import arbiter.operators.joins as J
    side = spark.range(0, 1000).withColumn("v", F.col("id") * 2)
    hinted = lambda: side.join(small(side), "id")._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in hinted() and "broadcast" in hinted()
    monkeypatch.setattr(J, "BROADCAST_LIMIT_BYTES", 10)                     # now the side is "too large"
    assert "ResolvedHint" not in hinted()


def test_rules_are_joined_once_per_field_set(spark):
    """The plan holds one join per set of tested fields, however many rules there are."""
    from arbiter.functions.rules import assign_groups
    df = spark.createDataFrame([(1, ["a", "b"])], "id INT, f ARRAY<STRING>")
    schema = "rule_order ARRAY<INT>, path ARRAY<STRUCT<field: INT, key: STRING>>, group_name STRING"

    def joins(n):
        rules = [([i], [(i % 2, f"k{i}")], f"g{i}") for i in range(n)]
        out = assign_groups(df, "f", spark.createDataFrame(rules, schema))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join LeftOuter"), len(plan)

    few, many = joins(10), joins(3000)
    assert few[0] == many[0] == 2 and many[1] < 1.2 * few[1]


def test_ordinal_has_no_single_partition(spark):
    from arbiter.operators.ordinal import with_ordinal
    df = spark.range(1000).selectExpr("id", "nullif(id % 3, 0) AS k")
    for out in (with_ordinal(df, ["id"]), with_ordinal(df, ["id"], partition_by=["k"])):
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 1000
    got = {(r.k, r.ord) for r in with_ordinal(df, ["id"], partition_by=["k"], partitions=5).collect()}
    assert got == {(k, i) for k, n in ((None, 334), (1, 333), (2, 333)) for i in range(n)}


def test_message_is_parsed_once(spark):
    from arbiter.functions.parsing import parse_updates
    df = spark.createDataFrame([('{"update":"a\\t1e17","group_id":"g"}',), ('{"update":"a\\t0.004","group_id":"g"}',),
                                ('{"update":"a\\t0","group_id":"g"}',)], "value STRING")
    ok, bad = parse_updates(df)
    assert ok._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [r.reason for r in bad.collect()] == ["cost_out_of_range"]
    assert sorted(str(r.score) for r in ok.collect()) == ["-0.004", "0.0"]


def test_topic_writer_keeps_options_key_and_trigger(spark):
    from arbiter.sources.topics import topic_rows, topic_writer

    class Writer:
        def __init__(self):
            self.seen = {}

        def option(self, k, v):
            self.seen[k] = v
            return self

        def format(self, f):
            self.seen["format"] = f
            return self

        def trigger(self, **t):
            self.seen["trigger"] = t
            return self

    w = topic_writer(Writer(), "cp", "t", "kafka", {"kafka.bootstrap.servers": "b:1"}, {"processingTime": "2 seconds"})
    assert w.seen == {"checkpointLocation": "cp", "format": "kafka", "kafka.bootstrap.servers": "b:1", "topic": "t",
                      "trigger": {"processingTime": "2 seconds"}}
    df = spark.createDataFrame([("k", "v", "t")], "key STRING, value STRING, topic STRING")
    assert topic_rows(df, None, "kafka").columns == ["value", "key", "topic"]


def test_missing_versions_and_broken_registries_are_errors(spark, tmp_path):
    import pytest
    from arbiter.sources.snapshots import SnapshotTable
    from arbiter.streaming.communicator import Communicator
    t = SnapshotTable(spark, str(tmp_path / "state"))
    t.write(spark.range(3), 0)
    with pytest.raises(ValueError, match="no version 9"):
        t.read(9)
    c = Communicator(spark, str(tmp_path / "comm"), "c1")
    assert c.registry().count() == 0
    (tmp_path / "comm" / "registry").mkdir(parents=True)
    (tmp_path / "comm" / "registry" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        c.registry().count()


def test_payload_escapes_names(spark):
    from arbiter.functions.parsing import eg_payload, parse_eg_payload
    df = spark.createDataFrame([('a"b', ["c\\d", "e"])], "best STRING, others ARRAY<STRING>")
    r = df.select(parse_eg_payload(eg_payload("best", "others", 0.1)).alias("p")).first().p
    assert (r.best, r.random, r.epsilon) == ('a"b', ["c\\d", "e"], 0.1)
