"""As-of lookup: each row meets the entry of its key that was in force at its time.

Rows and entries are range-partitioned together by key and time, so that a hot key is split by its times. The
last entry is carried forward inside each partition by a window and from partition to partition by one row per
(partition, key). No join on an inequality, no list of entries per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize as cut
from .joins import small


def as_of(rows: DataFrame, entries: DataFrame, key: str, at: str, since: str, values: Sequence[str], tie: str | None = None,
          partitions: int | None = None) -> DataFrame:
    """``rows`` with ``values`` of the entry of the same ``key`` with the largest ``since <= at``; null where there is none.

    Of entries with one key and time the one with the largest ``tie`` counts (without ``tie``: any one of them, the
    same in every run). ``at`` and ``since`` are of one type. A null key or time meets nothing. Rows come out as often as
    they came in; ``values`` replace columns of ``rows`` with those names.
    """
    kept = [c for c in rows.columns if c not in values]
    value = F.struct(*[F.col(c) for c in values])
    order = F.col(tie) if tie else F.xxhash64(value)
    events = entries.select(F.col(key).alias("_k"), F.col(since).alias("_t"), F.lit(0).alias("_side"), order.cast("string" if tie is None else
                            entries.schema[tie].dataType).alias("_tie"), value.alias("_v"))
    events = events.where("_k is not null and _t is not null")
    asked = rows.select(F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*kept).alias("_row"))
    both = events.unionByName(asked, allowMissingColumns=True)
    # rows of one instant are alike here; their hash splits a hot instant too
    sort = ["_k", "_t", "_side", "_tie"]
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(both.withColumn("_salt", F.when(F.col("_side") == 1, F.xxhash64("_row")))
                .repartitionByRange(n, *sort, "_salt").withColumn("_part", F.spark_partition_id()))
    here = Window.partitionBy("_part", "_k").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    is_entry = F.col("_side") == 0
    last = F.max_by(F.when(is_entry, F.col("_v")), F.when(is_entry, F.struct("_t", "_tie")))
    earlier = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (dealt.groupBy("_part", "_k").agg(last.alias("_last"))   # a key lies in neighbouring partitions: a row for each
               .select(F.col("_part").alias("_p"), F.col("_k").alias("_kk"), F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
               .where("_carry is not null"))
    found = dealt.withColumn("_now", F.last("_v", ignorenulls=True).over(here)).where("_side = 1")
    found = found.join(small(carried), (F.col("_part") == F.col("_p")) & (F.col("_k") == F.col("_kk")), "left")
    hit = F.when(F.col("_k").isNotNull() & F.col("_t").isNotNull(), F.coalesce("_now", "_carry"))
    return found.withColumn("_hit", hit).select("_row.*", *[F.col(f"_hit.{c}").alias(c) for c in values])
