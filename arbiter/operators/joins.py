"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Largest estimated plan size (bytes) we broadcast; beyond it the join shuffles both sides.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Most rows of a computed table that we broadcast after counting them.
BROADCAST_LIMIT_ROWS = 20_000


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. streaming plan, Spark Connect)
        return None
    # py4j hands a Scala BigInt back as a Python int; keep a fallback for a JVM object
    return int(size) if isinstance(size, int) else int(size.toString())


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when its estimated size is within ``limit``.

    Otherwise the frame is returned unchanged and Catalyst/AQE choose a shuffle join (AQE may
    still turn it into a broadcast at run time once real sizes are known).
    """
    size = estimated_bytes(df)
    if size is not None and size <= (BROADCAST_LIMIT_BYTES if limit is None else limit):
        return F.broadcast(df)
    return df


def counted_small(df: DataFrame, rows: int = BROADCAST_LIMIT_ROWS) -> DataFrame:
    """A copy of ``df``, marked for broadcast when it holds at most ``rows`` rows.

    For aggregates of few rows over joins, whose estimated size is that of their inputs multiplied: unmarked, every row
    of the other side would be shuffled by the few keys. A larger copy is joined as Catalyst/AQE choose.
    """
    copy = materialize(df)
    return F.broadcast(copy) if copy.limit(rows + 1).count() <= rows else copy
