"""Spark session and checkpoint helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamps in the inputs carry no zone),
# adaptive execution for runtime coalescing and skew splitting, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python dict semantics for maps built from lists with repeated keys: last one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Rows can be whole documents: Arrow batches of few rows and bytes keep Python workers' memory bounded.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
    # Keep one from_json per message: field pruning would split it into one parse per field
    # once a filter on the parsed fields is pushed below the parse.
    "spark.sql.optimizer.enableJsonExpressionOptimization": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "arbiter",
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.mapKeyDedupPolicy", "spark.sql.execution.arrow.maxRecordsPerBatch",
              "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.optimizer.enableJsonExpressionOptimization"):
        spark.conf.set(k, BASE_CONF[k])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when a local session (tests) names none, a private folder is created and set; on a cluster
    executors couldn't see it, so there an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on this session type (e.g. Spark Connect)
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir isn't set: name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="arbiter-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None:
        sc.setCheckpointDir(current)
    return current


def materialize(df, eager: bool = True):
    """Cut lineage: write ``df`` to the shared checkpoint folder and continue from the copy.

    Used where one expensive intermediate result feeds several passes (a scalar, a sample and
    the main job); re-reading the copy also survives the loss of the executors that made it.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
