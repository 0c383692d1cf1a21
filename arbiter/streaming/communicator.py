"""Cross-cluster communication as Structured Streaming queries.

Four flows share one subscriber registry (a table of distinct ``(group_id, cluster_id)``):

* ``upload``   -> 1 % feature-frequency sample, raw forwarding to the backend, one heartbeat per
  batch (one ``foreachBatch``: the batch is persisted once and written to three sinks, T10);
* ``subscribe``-> registry grows by set union, never expires (streaming de-duplication, T5);
* ``decision`` -> copies to every other subscribing cluster (stream-static join with the
  registry as of the batch, broadcast behind a size check; own cluster excluded);
* ``external`` -> each update forwarded to its owner's update topic, plus one ``group;own``
  subscription per group and batch (A13).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..operators import routing as R
from ..operators.aggregates import feature_frequency
from ..operators.sampling import sample_mask
from ..sources.topics import write_batch, write_brokers, write_destinations


class Communicator:
    def __init__(self, spark: SparkSession, root: str, own: str, sample_fraction: float = 0.01,
                 n_management: int = 2, origin: str | None = None, brokers: Mapping[str, Mapping[str, str]] | None = None):
        """``brokers``: options of every destination's broker (see ``write_brokers``); without them each destination gets a folder
        below ``root/outbox``. ``origin``: this cluster's tag in decision messages (``From: origin``). When given, only messages that
        carry it are fanned out, so clusters that subscribe to each other don't pass a decision round."""
        self.spark, self.own, self.origin, self.brokers = spark, own, origin, brokers
        self.root = root.rstrip("/")
        self.registry_path = f"{self.root}/registry"
        self.fraction, self.k = sample_fraction, n_management

    def _send(self, rows: DataFrame, flow: str, batch_id: int) -> None:
        if self.brokers is None:
            write_destinations(rows, f"{self.root}/outbox/{flow}", batch_id)
        else:
            write_brokers(rows, self.brokers, f"{self.root}/dead/{flow}", batch_id)

    # -- upload: sample + forward + heartbeat (T8, T10, A10, A25) --------------------------------
    def upload_batch(self, batch: DataFrame, batch_id: int) -> None:
        b = batch.select("value").persist()
        keyed = b.withColumn("_row", F.monotonically_increasing_id())
        sampled = keyed.where(sample_mask(F.concat_ws(":", F.lit(batch_id), F.col("_row")), self.fraction))
        counts = feature_frequency(P.feature_pairs(sampled, "value", self.k))
        write_batch(counts, f"{self.root}/sample", batch_id)
        write_batch(b.select("value"), f"{self.root}/upload", batch_id)
        write_batch(self.spark.createDataFrame([(self.own,)], "cluster_id STRING"), f"{self.root}/alive", batch_id)
        b.unpersist()

    # -- subscribe: registry by set union (T5) -----------------------------------------------------
    def subscriptions(self, stream: DataFrame) -> DataFrame:
        s = P.parse_subscription("value")
        return (stream.select(s["group_id"].alias("group_id"), s["cluster_id"].alias("cluster_id"))
                .where(F.col("group_id").isNotNull() & F.col("cluster_id").isNotNull())
                .dropDuplicates(["group_id", "cluster_id"]))

    def registry(self) -> DataFrame:
        """The subscriptions so far; only a missing folder means that there are none yet."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.registry_path)
        schema = "group_id STRING, cluster_id STRING"
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.registry_path).distinct()

    # -- decision: fan-out to subscribers (J2, E19, S3) ---------------------------------------------
    def decision_batch(self, batch: DataFrame, batch_id: int) -> None:
        d = P.parse_decision_message("value")
        dec = batch.select(d["group_id"].alias("group_id"), "value")
        if self.origin is not None:
            dec = dec.where(F.col("value").endswith(f";From: {self.origin}"))
        out = R.fan_out(dec, self.registry(), self.own)
        self._send(out.select(F.col("cluster_id").alias("dest_cluster"), F.lit("decision").alias("topic"), "value"), "decision", batch_id)

    # -- external: forward to the owner + subscribe once per group (S3, A13, E14) -------------------
    def external_batch(self, batch: DataFrame, batch_id: int) -> None:
        j = F.from_json("value", P.UPDATE_SCHEMA)
        rows = batch.select("value", j["group_id"].alias("group_id"), j["cluster_id"].alias("cluster_id"),
                            F.monotonically_increasing_id().alias("offset")).where(F.col("cluster_id").isNotNull())
        rows = rows.persist()
        fwd = rows.select(F.col("cluster_id").alias("dest_cluster"), F.lit(R.INTERNAL).alias("topic"), "value")
        subs = R.subscribe_to_owners(rows, self.own)
        subs = subs.select("dest_cluster", F.lit("subscribe").alias("topic"), F.col("message").alias("value"))
        self._send(fwd.unionByName(subs), "external", batch_id)
        rows.unpersist()

    # -- wiring (T7) ----------------------------------------------------------------------------------
    def start(self, upload: DataFrame, subscribe: DataFrame, decision: DataFrame, external: DataFrame,
              checkpoint: str, trigger: dict | None = None) -> list:
        trig = trigger or {"availableNow": True}
        cp = checkpoint.rstrip("/")
        qs = [self.subscriptions(subscribe).writeStream.option("checkpointLocation", f"{cp}/subscribe")
              .format("parquet").trigger(**trig).start(self.registry_path)]
        for name, df, fn in (("upload", upload, self.upload_batch), ("decision", decision, self.decision_batch),
                             ("external", external, self.external_batch)):
            qs.append(df.select("value").writeStream.option("checkpointLocation", f"{cp}/{name}")
                      .foreachBatch(fn).trigger(**trig).start())
        return qs


def liveness_view(alive: DataFrame, last_batch: int, max_silence: int = 1) -> DataFrame:
    """Clusters with their last heartbeat and whether they are still alive."""
    return R.liveness(alive, last_batch, cluster="cluster_id", batch="batch_id", max_silence=max_silence)

