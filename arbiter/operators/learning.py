"""Policies that learn over a trace (C8): every epoch is served with what the policy has learnt from the epochs before.

A policy is a table of slots: a request draws a slot and gets its decision, or, when that isn't on offer, a
pick from its own offered list. What a group's requests of one epoch would cost is added up before the policy is known: per
slot, for the fallback alone, and for every decision that a request offers, as the difference that being served it makes. These totals
are exact, distributed and combined map-side; only they reach the fold over epochs, one small task per group. The requests
themselves then meet their epoch's slots in a join.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import COST_SCALE, exact
from .joins import counted_small
from .policies import UCB_SCALE

Totals = dict[str, tuple[float, float]]


def _discounted(state: Totals, new: Totals, gamma: float) -> Totals:
    """One epoch of the discounted state: idle arms decay too."""
    out = {d: (s * gamma, c * gamma) for d, (s, c) in state.items()}
    return out | {d: (x[0] + out[d][0], x[1] + out[d][1]) if d in out else x for d, x in new.items()}


def _mean(total: tuple[float, float]) -> float:
    return total[0] / total[1] if total[1] > 0 else 0.0


@dataclass(frozen=True)
class Ucb:
    """A schedule of ``picks`` slots by discounted UCB; with ``reset`` the last epoch of each period serves ``random`` next and
    starts anew (A4)."""

    picks: int
    gamma: float
    reset: int | None = None

    @property
    def n_slots(self) -> int:
        return self.picks

    def start(self) -> Totals:
        return {}

    def learn(self, state: Totals, epoch: int, new: Totals) -> Totals:
        return {} if self.reset and (epoch + 1) % self.reset == 0 else _discounted(state, new, self.gamma)

    def slots(self, state: Totals) -> list[str]:
        arms = {d: [_mean(state[d]), state[d][1]] for d in sorted(state)}
        n, out = sum(math.floor(c) for _, c in state.values()), []
        for _ in range(self.picks if arms else 0):
            bonus = UCB_SCALE * math.sqrt(2.0 * math.log(n)) if n > 1 else 0.0
            best, most = None, -math.inf
            for d, (mean, c) in arms.items():
                score = mean + bonus / math.sqrt(c) if c > 0 else 0.0
                if score > most:
                    best, most = d, score
            out.append(best)
            arms[best][1] += 1
            n += 1
            for arm in arms.values():
                arm[1] *= self.gamma
        return out


@dataclass(frozen=True)
class EpsilonGreedy:
    """Of ``n_slots`` the first ``epsilon`` share explores the other arms in turn, the rest serves the best mean of the
    last ``window`` epochs (A2)."""

    epsilon: float
    window: int
    n_slots: int = 101

    def start(self) -> deque:
        return deque()

    def learn(self, state: deque, epoch: int, new: Totals) -> deque:
        state.append((epoch, new))
        while state[0][0] <= epoch - self.window:
            state.popleft()
        return state

    def slots(self, state: deque) -> list[str]:
        total: Totals = {}
        for _, new in state:
            for d, x in new.items():
                old = total.get(d, (0.0, 0.0))
                total[d] = (old[0] + x[0], old[1] + x[1])
        if not total:
            return []
        best = min(total, key=lambda d: (-_mean(total[d]), d))
        others = [d for d in sorted(total) if d != best]
        return [others[u % len(others)] if others and u < self.epsilon * 100 else best for u in range(self.n_slots)]


@dataclass(frozen=True)
class Weighted:
    """C4: an arm's weight is its share of the inverse discounted mean costs, in whole basis points; slot u goes to the first arm
    whose cumulative weight reaches u per cent, beyond the total to the last."""

    gamma: float
    n_slots: int = 101

    def start(self) -> Totals:
        return {}

    def learn(self, state: Totals, epoch: int, new: Totals) -> Totals:
        return _discounted(state, new, self.gamma)

    def slots(self, state: Totals) -> list[str]:
        if not state:
            return []
        inverse = {d: state[d][1] / max(-state[d][0], 1e-9) for d in sorted(state)}
        whole, points, out = sum(inverse.values()), [], []
        for d, x in inverse.items():
            points.append((d, (points[-1][1] if points else 0) + math.floor(10000 * x / whole)))
        for u in range(self.n_slots):
            out.append(next((d for d, cum in points if cum >= 100 * u), points[-1][0]))
        return out


Policy = Ucb | EpsilonGreedy | Weighted


def fallback_pick(offered: Column, draw: Column) -> Column:
    """Uniform over the offered list by the request's second draw; null when nothing is on offer."""
    return F.get(offered, F.pmod(F.floor(draw / 7), F.greatest(F.size(offered), F.lit(1))).cast("int"))


def _requests(records: DataFrame, draw: str, n_slots: int) -> DataFrame:
    offered = F.map_keys("decision_map")
    return (records.withColumn("_slot", F.pmod(F.col(draw), F.lit(n_slots)).cast("int"))
            .withColumn("_fallback", fallback_pick(offered, F.col(draw))))


def what_if(records: DataFrame, n_slots: int, group: str = "group_id", epoch: str = "epoch", draw: str = "line_no") -> DataFrame:
    """Per (group, epoch, slot, served, decision): exact cost units and number of requests that end up with ``decision``. Rows
    with ``served`` null hold what the fallback alone gives; rows of a ``served`` decision are to be added when the slot serves it."""
    r = _requests(records, draw, n_slots)
    cost = F.try_element_at("decision_map", F.col("_fallback"))
    none = F.lit(None).cast("string")
    entry = lambda served, got, c, sign: F.struct(served.alias("served"), got.alias("decision"),
                                                  (exact(c) * sign).alias("cost"), F.lit(sign).cast("long").alias("n"))
    each = F.transform(F.map_entries("decision_map"), lambda e: F.array(
        entry(e["key"], e["key"], e["value"], 1), entry(e["key"], F.col("_fallback"), F.col("_fbcost"), -1)))
    rows = (r.where("_fallback is not null").withColumn("_fbcost", cost)
            .select(F.col(group).alias("group_id"), F.col(epoch).alias("epoch"), F.col("_slot").alias("slot"),
                    F.inline(F.concat(F.array(entry(none, F.col("_fallback"), F.col("_fbcost"), 1)), F.flatten(each)))))
    return (rows.groupBy("group_id", "epoch", "slot", "served", "decision")
            .agg((F.sum("cost") * 10 ** COST_SCALE).cast("decimal(38,0)").alias("units"), F.sum("n").alias("n")))


def _fold(policy: Policy) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        by_epoch = {e: part for e, part in rows.groupby("epoch")}
        state, out = policy.start(), []
        for epoch in range(min(by_epoch), max(by_epoch) + 1):
            new: dict[str, list[int]] = {}
            if epoch in by_epoch:
                slots = policy.slots(state)
                out.append((rows["group_id"].iloc[0], epoch, slots))
                for slot, served, decision, units, n in by_epoch[epoch][["slot", "served", "decision", "units", "n"]].itertuples(index=False):
                    if served is None or slots and slots[slot] == served:
                        total = new.setdefault(decision, [0, 0])
                        total[0], total[1] = total[0] + int(units), total[1] + int(n)
            exact_totals = {d: (float(Decimal(-u).scaleb(-COST_SCALE)), float(n)) for d, (u, n) in new.items() if n}
            state = policy.learn(state, epoch, exact_totals)
        return pd.DataFrame(out, columns=["group_id", "epoch", "slots"])
    return fold


def learnt_slots(records: DataFrame, policy: Policy, group: str = "group_id", epoch: str = "epoch", draw: str = "line_no",
                 totals: DataFrame | None = None) -> DataFrame:
    """(group_id, epoch, slots): what each group serves in each of its epochs, learnt from the costs that this very serving caused in
    the epochs before. A group's fold gets totals only: its epochs x slots x decisions squared at most. ``totals`` are those of
    ``what_if`` for the policy's number of slots, if they are there already."""
    if totals is None:
        totals = what_if(records, policy.n_slots, group, epoch, draw)
    return totals.groupBy("group_id").applyInPandas(_fold(policy), "group_id string, epoch long, slots array<string>")


def evaluate_learning(records: DataFrame, policy: Policy, group: str = "group_id", epoch: str = "epoch", draw: str = "line_no",
                      totals: DataFrame | None = None) -> DataFrame:
    """``records`` with ``slots``, ``chosen`` (null when nothing is on offer), ``from_policy`` and the ``cost`` of the choice."""
    slots = learnt_slots(records, policy, group, epoch, draw, totals).select(
        F.col("group_id").alias("_g"), F.col("epoch").alias("_e"), F.col("slots").alias("slots"))
    r = _requests(records, draw, policy.n_slots)
    j = r.join(counted_small(slots), F.col(group).eqNullSafe(F.col("_g")) & (F.col(epoch) == F.col("_e")), "left")
    pick = F.get("slots", F.col("_slot"))
    ok = pick.isNotNull() & F.coalesce(F.map_contains_key("decision_map", F.coalesce(pick, F.lit(""))), F.lit(False))
    return (j.withColumn("from_policy", ok).withColumn("chosen", F.when(ok, pick).otherwise(F.col("_fallback")))
            .withColumn("cost", F.try_element_at("decision_map", F.col("chosen"))).drop("_g", "_e", "_slot", "_fallback"))
