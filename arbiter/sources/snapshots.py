"""Versioned snapshot tables for streaming upserts (S6, S7, T6, and the T1 state table).

Each micro-batch writes a complete new version ``<root>/v=<batch_id>`` (overwrite, so a
replayed batch rewrites the same version: idempotent), computed as a keyed merge of the
previous version with the batch. Readers take the highest version. Storage is any Hadoop file
system (the shared checkpoint folder on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._fs()
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if name.startswith("v=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(int(name[2:]))
        return sorted(out)

    def read(self, version: int | None = None, schema: str | None = None) -> DataFrame | None:
        vs = self.versions()
        if version is None:
            version = vs[-1] if vs else None
        elif version not in vs:
            raise ValueError(f"{self.root} has no version {version}; it has {vs[-5:]}")
        if version is None:
            return self.spark.createDataFrame([], schema) if schema else None
        return self.spark.read.parquet(f"{self.root}/v={version}")

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/v={version}")


def upsert_latest(old: DataFrame | None, batch: DataFrame, key: str, value: str, offset: str) -> DataFrame:
    """A12 keyed upsert: the latest value per key by offset, across the snapshot and the batch."""
    new = batch.groupBy(key).agg(F.max_by(value, offset).alias(value), F.max(offset).alias(offset))
    if old is None:
        return new
    both = old.select(key, value, offset).unionByName(new)
    return both.groupBy(key).agg(F.max_by(value, offset).alias(value), F.max(offset).alias(offset))


def collect_latest(spark: SparkSession, root: str, key: str = "group_id", value: str = "payload", offset: str = "offset"):
    """S6 as a ``foreachBatch`` function: keep the current decision per group."""
    table = SnapshotTable(spark, root)

    def run(batch: DataFrame, batch_id: int) -> None:
        prev = table.read(batch_id - 1) if batch_id > 0 else None
        table.write(upsert_latest(prev, batch, key, value, offset), batch_id)
    return run
