"""Per-batch stream metrics (A24): records handled per drain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def count_per_batch(root: str):
    """``foreachBatch`` function writing ``n_records`` per batch (a distributed count) into the
    batch's own folder (idempotent on replay); read back with ``batch_id`` as partition column."""
    from ..sources.topics import write_batch

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.agg(F.count(F.lit(1)).alias("n_records")), root, batch_id)
    return run


def drain_counts(spark: SparkSession, query) -> DataFrame:
    """``(batch_id, num_input_rows)`` from the query's recent progress reports (driver metadata,
    bounded by ``spark.sql.streaming.numRecentProgressUpdates``)."""
    rows = [(int(p["batchId"]), int(p["numInputRows"])) for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id BIGINT, num_input_rows BIGINT")
