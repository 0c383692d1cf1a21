"""Distributed ordinals and bounded look-back (W8, section 7.5.4 of the design).

An unpartitioned window (``row_number() over (order by ...)``) pulls all rows into one task.
Here rows are range-partitioned on the keys (a hot group is split by its order keys), numbered inside
their partition, and shifted by the row counts of the partitions before. One way for every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize as cut
from .joins import small


def with_ordinal(df: DataFrame, order: Sequence[str], partition_by: Sequence[str] = (), name: str = "ord",
                 partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (within ``partition_by`` groups when given; nulls are a group).

    ``partition_by + order`` must identify rows (add a unique tiebreaker). The range-partitioned rows are
    written once (a checkpoint), so that the counts and the ranks see the same partitions, also after
    a lost executor.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(df.repartitionByRange(n, *partition_by, *order).withColumn("_part", F.spark_partition_id()))
    counts = rows.groupBy("_part", *partition_by).agg(F.count(F.lit(1)).alias("_n"))
    if partition_by:  # a group lies in neighbouring partitions: a row for each
        w = Window.partitionBy(*partition_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    else:  # at most n rows
        earlier = F.broadcast(counts.select(F.col("_part").alias("_p"), F.col("_n").alias("_m")))
        before = (counts.join(earlier, F.col("_p") < F.col("_part"), "left")
                  .groupBy("_part").agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("_before")))
    local = F.row_number().over(Window.partitionBy("_part", *partition_by).orderBy(*order))
    keys = ["_part", *partition_by]
    before = before.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], "_before")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_b{i}"))
    out = rows.withColumn("_local", local).join(small(before) if partition_by else F.broadcast(before), same)
    return (out.withColumn(name, (F.col("_before") + F.col("_local") - 1).cast("bigint"))
            .drop("_local", "_before", "_part", *[f"_b{i}" for i in range(len(keys))]))


def with_lookback(df: DataFrame, ord_col: str, lookback: int, block: int = 65536,
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Tag rows with ``_blk = ord div block`` and copy the last ``lookback`` rows of every block
    into the next block as carry rows (``_carry = true``).

    A window ``partitionBy(*partition_by, "_blk").orderBy(ord)`` with a frame reaching at most
    ``lookback`` rows back then sees every row it needs, while each window partition holds at
    most ``block + lookback`` rows. Drop carry rows after the window.
    """
    if lookback >= block:
        raise ValueError("lookback must be smaller than the block")
    blk = F.floor(F.col(ord_col) / block)
    own = F.struct(blk.alias("_blk"), F.lit(False).alias("_carry"))
    carry = F.struct((blk + 1).alias("_blk"), F.lit(True).alias("_carry"))
    copies = F.when(F.pmod(F.col(ord_col), F.lit(block)) >= block - lookback, F.array(own, carry)).otherwise(F.array(own))
    return df.select("*", F.inline(copies))


def lag_global(df: DataFrame, ord_col: str, col: str | Column, name: str, block: int = 65536,
               partition_by: Sequence[str] = ()) -> DataFrame:
    """``lag(col)`` in global ``ord_col`` order without a single-partition window."""
    c = F.col(col) if isinstance(col, str) else col
    t = with_lookback(df.withColumn("_v", c), ord_col, 1, block, partition_by)
    w = Window.partitionBy(*partition_by, "_blk").orderBy(ord_col)
    return (t.withColumn(name, F.lag("_v").over(w)).where(~F.col("_carry"))
            .drop("_v", "_blk", "_carry"))
