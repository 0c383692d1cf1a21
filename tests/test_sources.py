"""Write / read-back round trips for the file, spool and snapshot sources and sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from arbiter.sources import files as S
from arbiter.sources.snapshots import SnapshotTable, upsert_latest
from arbiter.sources.topics import read_spool, spool_lines


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_run_log_series_outcomes_report_tsv_routes(spark):
    d = tempfile.mkdtemp(prefix="arbiter-src-")
    _write(f"{d}/log/a.log", "0,online,3.5\n1,local,6.0\n")
    log = S.read_run_log(spark, f"{d}/log")
    assert sorted((r.url_idx, r.status, r.cost) for r in log.collect()) == [(0, "online", 3.5), (1, "local", 6.0)]

    _write(f"{d}/series/s.txt", "".join(f"{v}\n" for v in (5, 3, 9, 1)))
    s = S.read_series(spark, f"{d}/series")
    assert [r.value for r in s.orderBy("i").collect()] == [5.0, 3.0, 9.0, 1.0]

    _write(f"{d}/bm/w1.bm", "[3, 10.0, 0.3]\n[0, 1469.5, 1470.1, 0.6, 1]\n[1, 1469.6, 1470.0, 0.4, 1]\n")
    _write(f"{d}/bm/w2.bm", "[1, 20.0, 0.05]\n[0, 1469.9, 1470.9, 1.0, 0]\n")
    h, o = S.read_outcomes(spark, f"{d}/bm")
    assert h.count() == 2 and o.count() == 3
    assert o.where("result = 1").agg(F.avg("resp_time")).first()[0] == 0.5

    _write(f"{d}/rep/r.txt", "Concurrency Level: 7\nRequests per second:    123.45 [#/sec] (mean)\n"
                             "Time per request:       56.7 [ms] (mean)\nTime per request:       8.1 [ms] (mean, across all concurrent requests)\n")
    r = S.scrape_report(spark, f"{d}/rep").collect()[0]
    assert (r.rps, r.time_per_request) == (123.45, 56.7)

    _write(f"{d}/tsv/t.tsv", "a\tb\n1\tx\n2\ty\n")
    assert S.read_tsv(spark, f"{d}/tsv", "a INT, b STRING").count() == 2

    _write(f"{d}/routes/r.txt", "k1;10.0.0.1:80\nk2;10.0.0.2:80;extra\nk1;10.0.0.9:80\n")
    rt = S.read_route_table(spark, f"{d}/routes")
    first = rt.groupBy("label").agg(F.min_by("address", "ord").alias("a"))
    assert dict((r.label, r.a) for r in first.collect()) == {"k1": "10.0.0.1:80", "k2": "10.0.0.2:80;extra"}

    out = f"{d}/res"
    S.write_tsv(spark.createDataFrame([(0, 1.5)], "sec INT, v DOUBLE"), out)
    assert spark.read.option("sep", "\t").csv(out).count() == 1


def test_spool_round_trip(spark):
    d = tempfile.mkdtemp(prefix="arbiter-spool-")
    rows = spark.createDataFrame([("cdnA\t1.0", "g1"), ("cdnB\t2.0", "g2")], "update STRING, group_id STRING")
    spool_lines(rows).write.text(f"{d}/spool")
    _write(f"{d}/spool/bad.txt", "not json\n")
    q = (read_spool(spark, f"{d}/spool", archive=f"{d}/archive").writeStream.format("memory").queryName("spool_t")
         .option("checkpointLocation", f"{d}/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("spool_t")
    assert sorted((r.update, r.group_id) for r in got.where("group_id IS NOT NULL").collect()) == \
        [("cdnA\t1.0", "g1"), ("cdnB\t2.0", "g2")]
    assert got.where("group_id IS NULL").count() == 1   # the bad line is kept as a reject, the file is not lost


def test_snapshot_latest_wins(spark):
    d = tempfile.mkdtemp(prefix="arbiter-snap-")
    t = SnapshotTable(spark, d)
    b0 = spark.createDataFrame([("g1", "a", 1), ("g1", "b", 2), ("g2", "x", 3)], "group_id STRING, payload STRING, offset BIGINT")
    t.write(upsert_latest(None, b0, "group_id", "payload", "offset"), 0)
    b1 = spark.createDataFrame([("g2", "y", 7)], "group_id STRING, payload STRING, offset BIGINT")
    t.write(upsert_latest(t.read(0), b1, "group_id", "payload", "offset"), 1)
    t.write(upsert_latest(t.read(0), b1, "group_id", "payload", "offset"), 1)   # replay: idempotent
    assert t.versions() == [0, 1]
    assert sorted((r.group_id, r.payload) for r in t.read().collect()) == [("g1", "b"), ("g2", "y")]


def test_line_numbers_across_splits(spark):
    d = tempfile.mkdtemp(prefix="arbiter-lines-")
    _write(f"{d}/big/a.txt", "".join(f"{i}\n" for i in range(200000)))
    _write(f"{d}/big/b.txt", "".join(f"{i}\n" for i in range(10)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        lines = S.read_lines(spark, f"{d}/big")
        assert spark.read.text(f"{d}/big").rdd.getNumPartitions() > 4      # really split
        bad = lines.where(F.col("line_no") != F.col("value").cast("bigint")).count()
        assert bad == 0 and lines.count() == 200010
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
