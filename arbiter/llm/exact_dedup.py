"""Exact de-duplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by SHA-256 digest. A batch is reduced to one row
per digest, sort-merge anti-joined to the index, and its new digests are appended. Only DataFrame
operations run. Adding the same batch again (a retry) appends nothing and decides alike.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.llm.common import hot_join, stage


class DigestIndex:
    """Digests of every text seen so far, with the id of the row that stays for each.

    ``path`` is a shared folder; opening it again, from any session, goes on with its content.
    The bucket count is fixed when the folder is made and must be passed alike later.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT)
                      USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS
                      LOCATION '{path}'""")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """``groups``: digest, keep_id, one row per digest. Adds those the index doesn't hold."""
        fresh = groups.select("digest", "keep_id").join(self.rows().select("digest").hint("merge"),
                                                        "digest", "left_anti")
        # dealt by bucket, so that a bucket is one file however many partitions there are; four to a bucket, as few meet then
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        (fresh.withColumn("_bucket", bucket).repartition(4 * self.buckets, "_bucket").sortWithinPartitions("_bucket", "digest")
         .drop("_bucket").write.insertInto(self.table))

    def deduplicate(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 1) -> DataFrame:
        """One row per input row: ``id_col``, digest, keep_id, group_size, kept.

        Texts are equal when identical; null counts as empty. Of equal texts in the batch the row
        with the largest id stays (null ids last), unless the index held the text before: then
        its row stays and all of the batch go. ``group_size`` counts the rows of ``docs``. Rows
        repeated with the same id and text are one decision, and one of them stays. An empty batch
        gives no rows. Other columns of ``docs`` aren't looked at.

        ``docs`` is fed in ``batches`` ranges of descending id, null ids in the last, so that the largest id of a text is
        in the index before the others meet it there; the decisions are the same for any number of batches.
        """
        digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
        rows = stage(docs.select(F.col(id_col).cast("long").alias("id"), digest.alias("digest"))
                     .groupBy("id", "digest").agg(F.count("*").alias("copies")), "digests")
        shares = [i / batches for i in range(1, batches)]
        cuts = sorted({int(c) for c in rows.approxQuantile("id", shares, 0.01)}, reverse=True) if shares else []
        met = []
        for low, high in zip([*cuts, None], [None, *cuts], strict=True):
            batch = rows if low is None else rows.filter(F.col("id") > low)
            batch = batch if high is None else batch.filter((F.col("id") <= high) | F.col("id").isNull())
            met.append(stage(batch.groupBy("digest").agg(
                F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"),
                F.count("*").alias("n_rows")), "digest-groups"))
            self.append(met[-1])
        groups = reduce(DataFrame.unionByName, met)
        if len(met) > 1:
            groups = groups.groupBy("digest").agg(F.sum("group_size").alias("group_size"), F.sum("n_rows").alias("n_rows"))
        decided = groups.select("digest", "group_size", "n_rows").join(self.rows().hint("merge"), "digest")
        total = rows.count()
        joined = hot_join(rows, decided, ["digest"], "n_rows", total)
        nth = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth")
        return (joined.select("*", nth)
                .select(F.col("id").alias(id_col), "digest", "keep_id", "group_size",
                        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept")))


def deduplicated(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; repeated rows with one id and text keep one."""
    kept = (index.deduplicate(docs, id_col, text_col).filter("kept")
            .select(F.col(id_col).alias("_keep"), F.col("digest").alias("_digest")))
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    marked = docs.withColumn("_d", digest)
    return (marked.join(kept, marked[id_col].eqNullSafe(kept["_keep"]) & (marked["_d"] == kept["_digest"]), "left_semi")
            .dropDuplicates([id_col, "_d"]).drop("_d"))
