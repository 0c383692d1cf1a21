"""Warm-start seed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def warm_start_rows(updates: DataFrame, copies: int, keys=("group_id",), order: str = "event_id") -> DataFrame:
    """Union the live updates with one historic update per group standing for ``copies`` rows.

    The historic update is the group's first one. Instead of materialising ``copies`` identical
    rows, the seed row carries a multiplicity (``weight``); window aggregates sum the weight.
    Output: the update columns plus ``weight`` (1 for live rows).
    """
    cols = [c for c in updates.columns if c not in keys]
    first = F.min_by(F.struct(*cols), F.col(order))
    seeds = (updates.groupBy(*keys).agg(first.alias("_s"))
             .select(*keys, "_s.*").withColumn("weight", F.lit(int(copies))))
    return updates.withColumn("weight", F.lit(1)).unionByName(seeds.select(*updates.columns, "weight"))
