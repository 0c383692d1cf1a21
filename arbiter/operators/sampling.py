"""Row sampling (A10, T8): a per-row key decides, so batch and streaming agree and reruns repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_mask(key: str | Column, fraction: float, method: str = "hash", seed: int = 42) -> Column:
    """Keep ~``fraction`` of rows. ``hash``: seeded xxhash64 of the row key (production; hashing a
    *row* key, not the value, so equal values are not kept or dropped together). ``key_mod``:
    every ``1/fraction``-th integer key (deterministic and reproducible by other engines)."""
    k = F.col(key) if isinstance(key, str) else key
    if method == "key_mod":
        return F.pmod(k, F.lit(int(round(1 / fraction)))) == 0
    buckets = 1_000_000
    return F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(buckets)) < F.lit(int(fraction * buckets))


def sample_rows(df: DataFrame, key: str, fraction: float, method: str = "hash", seed: int = 42) -> DataFrame:
    return df.where(sample_mask(key, fraction, method, seed))
