"""Topic and spool sources/sinks (S1-S5) for Structured Streaming.

The message bus format is a parameter: ``kafka`` on a cluster (the connector jar must be on
the classpath), or a directory of text files per topic (tests, and where no broker exists).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, topic: str, fmt: str = "kafka", root: str | None = None,
               options: dict | None = None) -> DataFrame:
    """Stream of string values ``(value, timestamp)``."""
    opts = dict(options or {})
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("subscribe", topic)
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load().select(F.col("value").cast("string").alias("value"), "timestamp", "offset")
    r = spark.readStream.format("text")
    for k, v in opts.items():
        r = r.option(k, v)
    # a file's place in time stands for the broker's offset; lines of one file share it
    offset = F.unix_micros("_metadata.file_modification_time")
    return r.load(f"{root.rstrip('/')}/{topic}").select("value", F.current_timestamp().alias("timestamp"), offset.alias("offset"))


def write_topic(df: DataFrame, checkpoint: str, topic: str | None = None, fmt: str = "kafka",
                root: str | None = None, options: dict | None = None, trigger: dict | None = None):
    """One message per row. With a ``topic`` column and no fixed topic, each row is routed
    by its own topic (Kafka does this natively; the file form partitions by topic)."""
    out = topic_rows(df, topic, fmt)
    w = topic_writer(out.writeStream, checkpoint, topic, fmt, options, trigger)
    if fmt == "kafka":
        return w.start()
    return w.start(f"{root.rstrip('/')}/{topic}" if topic is not None else root)


def topic_rows(df: DataFrame, topic: str | None, fmt: str) -> DataFrame:
    """The columns a topic sink takes: value, the key if there is one (Kafka), the topic if it isn't fixed."""
    cols = [F.col("value").cast("string").alias("value")]
    if fmt == "kafka" and "key" in df.columns:
        cols.append(F.col("key").cast("string").alias("key"))
    return df.select(*cols, *(["topic"] if topic is None else []))


def topic_writer(w, checkpoint: str, topic: str | None, fmt: str, options: dict | None, trigger: dict | None):
    """The stream writer with its checkpoint, all options, the trigger and the routing by topic."""
    w = w.option("checkpointLocation", checkpoint).format("kafka" if fmt == "kafka" else "text")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "kafka" and topic is not None:
        w = w.option("topic", topic)
    if fmt != "kafka" and topic is None:
        w = w.partitionBy("topic")
    return w.trigger(**(trigger or {"availableNow": True})) if trigger or topic is None and fmt != "kafka" else w


def write_batch(df: DataFrame, root: str, batch_id: int, fmt: str = "parquet", partition_by=()) -> None:
    """Write one micro-batch's output to its own ``batch_id=<n>`` folder, replacing it: a batch
    replayed after a failure rewrites its output instead of appending it twice."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(f"{root.rstrip('/')}/batch_id={batch_id}")


def write_destinations(batch: DataFrame, root: str, batch_id: int, fmt: str = "text") -> None:
    """S3: multi-destination write for one batch: rows carry ``dest_cluster`` and ``topic``;
    each destination gets its own folder (a broker per cluster in the Kafka form)."""
    write_batch(batch.select("dest_cluster", "topic", "value"), root, batch_id, fmt, ("dest_cluster", "topic"))


def write_brokers(batch: DataFrame, brokers: Mapping[str, Mapping[str, str]], dead: str, batch_id: int) -> None:
    """S3 with a broker per destination: ``batch`` has ``dest_cluster``, ``topic`` and ``value``; ``brokers`` is the table of configured
    destinations, cluster -> writer options with ``format`` (default ``kafka``) among them.

    The batch is persisted once; each destination gets one filtered write to its own broker (file formats: to their ``path``, a
    folder per batch, replay-safe). Rows for a cluster that isn't configured, or for none, go to dead letters.
    """
    rows = batch.select("dest_cluster", "topic", "value").persist()
    for cluster, given in brokers.items():
        options = dict(given)
        fmt = options.pop("format", "kafka")
        own = rows.where(F.col("dest_cluster") == cluster).select("topic", "value")
        if fmt == "kafka":
            own.write.format(fmt).options(**options).save()
        else:
            write_batch(own, options.pop("path"), batch_id, fmt, ("topic",))
    known = F.coalesce(F.col("dest_cluster").isin(*brokers), F.lit(False)) if brokers else F.lit(False)
    write_batch(rows.where(~known), dead, batch_id)
    rows.unpersist()


SPOOL_SCHEMA = "update STRING, group_id STRING"


def read_spool(spark: SparkSession, path: str, archive: str | None = None) -> DataFrame:
    """JSON-line spool files as a stream; processed files are archived (the checkpoint
    replaces the reference's rename-then-delete). Bad lines yield null fields, not a lost file."""
    r = spark.readStream.format("text")
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = r.load(path)
    return raw.select("value", F.from_json("value", SPOOL_SCHEMA).alias("j")).select("value", "j.*")


def spool_lines(df: DataFrame, update: str = "update", group: str = "group_id") -> DataFrame:
    """Rows -> JSON lines ``{"update", "group_id"}`` for an append-only text sink."""
    return df.select(F.to_json(F.struct(F.col(update).alias("update"), F.col(group).alias("group_id"))).alias("value"))
