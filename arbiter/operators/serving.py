"""Serving: score a whole request table against the current decision table.

The web tier of the reference answers one request at a time with ``rand``; here every pick is
a function of a per-request integer ``u`` (e.g. derived from the request id or a seeded hash),
so runs repeat. Each request is joined once (stream-static / broadcast when small) to its
group's decision row; the pick itself is a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import as_of
from .joins import small


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def seeded_int(key: str | Column, seed: int, n: int | Column) -> Column:
    """Seeded hash of a request key in ``[0, n)`` (replaces ``rand``)."""
    return F.pmod(F.xxhash64(_c(key), F.lit(seed)), n if isinstance(n, Column) else F.lit(n))


def lookup(requests: DataFrame, table: DataFrame, group: str = "group_id") -> DataFrame:
    """Request -> current decision row of its group (left lookup)."""
    return requests.join(small(table), group, "left")


def lookup_as_of(requests: DataFrame, table: DataFrame, values: list[str], group: str = "group_id", at: str = "ts_us",
                 since: str = "since_us") -> DataFrame:
    """Request -> the decision row that was in force at its own time; ``table`` has one row per group and change."""
    return as_of(requests, table, group, at, since, values)


def schedule_pick(schedule: str | Column, offered: str | Column, u1: Column, u2: Column) -> dict[str, Column]:
    """C1 + E17: uniform pick from the schedule (repeats weight it); if empty or not offered,
    uniform over the offered list."""
    arr = F.split(F.btrim(_c(schedule), F.lit(": ")), ":")
    n = F.size(arr)
    pick = F.when(n > 0, F.get(arr, F.pmod(u1, n)))
    ok = pick.isNotNull() & (pick != "") & F.coalesce(F.array_contains(_c(offered), pick), F.lit(False))
    fallback = F.get(_c(offered), F.pmod(u2, F.greatest(F.size(_c(offered)), F.lit(1))))
    return {"decision": F.when(ok, pick).otherwise(fallback), "from_schedule": ok}


def epsilon_pick(best: str | Column, others: str | Column, epsilon: str | Column | float, u: Column, u2: Column,
                 explore_when: str = "lt") -> dict[str, Column]:
    """C2 (``explore_when='gt'``, the reference's inverted test) and C3 (``'lt'``), with C6:
    a group with one known option always uses it. ``u`` is uniform in [0, 100]."""
    eps = F.lit(float(epsilon)) if isinstance(epsilon, float) else _c(epsilon)
    thr = eps * 100
    explore = (u > thr) if explore_when == "gt" else (u < thr)
    o = _c(others)
    explore = explore & (F.size(o) > 0)
    pick = F.when(explore, F.get(o, F.pmod(u2, F.greatest(F.size(o), F.lit(1))))).otherwise(_c(best))
    return {"decision": pick, "explored": explore}


def weight_table(weights: DataFrame, group: str = "group_id", order: str = "ord", name: str = "name",
                 weight: str = "weight") -> DataFrame:
    """Per group, the arms in order with their cumulative weight (one small array per group)."""
    arms = weights.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, name, weight))).alias("_a"))
    cum = F.aggregate("_a", F.array().cast(f"array<struct<name:string,cum:{dict(weights.dtypes)[weight]}>>"),
                      lambda acc, a: F.concat(acc, F.array(F.struct(
                          a[name].alias("name"),
                          (F.when(F.size(acc) > 0, F.get(acc, F.size(acc) - 1)["cum"]).otherwise(F.lit(0))
                           + a[weight]).cast(dict(weights.dtypes)[weight]).alias("cum")))))
    return arms.select(group, cum.alias("cum_weights"))


def weighted_pick(cum_weights: str | Column, u: Column) -> Column:
    """C4: first arm whose cumulative weight x 100 reaches ``u``; beyond the total, the last."""
    cw = _c(cum_weights)
    hit = F.filter(cw, lambda a: a["cum"] * 100 >= u)
    return F.when(F.size(hit) > 0, F.get(hit, 0)["name"]).otherwise(F.get(cw, F.size(cw) - 1)["name"])


def round_robin(ord_col: str | Column, n: int) -> Column:
    """Record ``ord`` goes to endpoint ``ord mod n``."""
    return F.pmod(_c(ord_col), F.lit(n))
