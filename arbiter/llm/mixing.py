"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact token length per source. A source's whole repeats are taken first;
the remaining budget is filled from the length counts: a proportional share of each length, whose
fractions are rounded by a seeded draw that favours no length, then a bounded-knapsack dynamic program
for the words that are missing or too many. Which documents of a length are taken follows a seeded hash of their id.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from arbiter.llm.common import global_rank, hot_join, n_words, row_key, stage


def fit_counts(lengths: Sequence[int], counts: Sequence[int], budget: int, seed: str = "") -> list[int]:
    """How many documents of each length to take, so that their words come as near to ``budget`` as found.

    First a proportional share of every length, rounded by ``_rounded``, which leaves at most about two
    documents' words missing or too many. Then bounded-knapsack dynamic programming over the documents left
    (or taken, when words are too many) takes (gives back) the sum nearest to that rest, as long as it shrinks.
    """
    size = np.asarray(lengths, dtype=np.int64)
    have = np.where(size > 0, np.asarray(counts, dtype=np.int64), 0)
    total = int((size * have).sum())
    if budget <= 0 or total == 0:
        return [0] * len(size)
    if budget >= total:
        return have.tolist()
    rng = random.Random(seed)
    taken = _rounded(size, have, budget, total, rng)
    order = rng.sample(range(len(size)), len(size))
    while rest := budget - int((size * taken).sum()):
        sign, free = (1, have - taken) if rest > 0 else (-1, taken)
        picked = _nearest([(int(size[i]), int(free[i]), i) for i in order if free[i]], abs(rest))
        if not picked:
            break
        for i, n in picked:
            taken[i] += sign * n
    return taken.tolist()


def _rounded(size: np.ndarray, have: np.ndarray, budget: int, total: int, rng: random.Random) -> np.ndarray:
    """``have * budget / total``, each rounded up or down: up with the chance of its fraction, whatever its length.

    Ordered pivotal draws by length: of two fractions in turn one is settled and the other carries on
    what both had, so the documents up to any length are within one of their share.
    """
    taken = np.array([int(c) * budget // total for c in have], dtype=np.int64)
    held, a = None, 0.0
    for i in np.argsort(size, kind="stable").tolist():
        b = int(have[i]) * budget % total / total
        if not b:
            continue
        if held is None:
            held, a = i, b
        elif a + b < 1:
            held, a = i if rng.random() * (a + b) < b else held, a + b
        else:
            up, other = (held, i) if rng.random() * (2 - a - b) < 1 - b else (i, held)
            taken[up] += 1
            held, a = other, a + b - 1
    if held is not None and rng.random() < a:
        taken[held] += 1
    return taken


def _nearest(items: list[tuple[int, int, int]], rest: int) -> list[tuple[int, int]]:
    """Bounded knapsack: (index, count) pairs whose words come nearest to ``rest``, the smaller on a tie.
    items: (length, count, index), looked at in their order until ``rest`` is met."""
    top = 2 * rest  # nothing above lies nearer than nothing at all
    first = np.full(top + 1, -1, dtype=np.int32)  # the layer that first made a sum; layer 0: nothing taken
    first[0], layers = 0, [(0, 0, 0)]
    for length, count, index in items:
        count, chunk = min(count, top // length), 1
        while count > 0 and first[rest] < 0:
            n = min(chunk, count)
            words = length * n
            made = (first[:top + 1 - words] >= 0) & (first[words:] < 0)
            first[words:][made] = len(layers)
            layers.append((words, index, n))
            count, chunk = count - n, chunk * 2
        if first[rest] >= 0:
            break
    sums = np.flatnonzero(first >= 0)
    at, picked = int(sums[np.abs(sums - rest).argmin()]), []
    while at:
        words, index, n = layers[first[at]]
        picked.append((index, n))
        at -= words
    return picked


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``sizes``: source_key, source_rank, source_size. Adds ``target``.

    Sources weigh ``weights`` by rank, repeating, and share ``share`` times all words. A target
    stops at ``most`` times its source; the excess goes to the others by weight until none is above.
    Each round is one aggregate over the sources; the driver sees two sums.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("source_rank") % len(weights) + 1).cast("int"))
    table = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    budget = float(share) * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("cap") if capped >= 0 else F.lit(False)
        fixed, free, n = table.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))),
                                   F.count(F.when(full, 1))).first()
        if not free or n == capped:
            break
        level, capped = (budget - float(fixed or 0)) / float(free), n
    return table.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.lit(level))).drop("weight", "cap")


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             keep: Sequence[str] = (), weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
             most: float = 2.0, seed: int = 42) -> DataFrame:
    """One row per input row: ``id_col``, ``source_col``, ``keep``, size, source_size, target, copies, taken.

    ``size`` counts words (null text: 0); ``copies`` is how often the mix takes the document and
    ``taken`` the words of all copies. Sources rank by code point, a null source is one of its own
    and ranks last. Documents without words take nothing but their source's whole repeats. Ties in
    the seeded hash (repeated ids) go by id; rows alike in both are interchangeable. An empty table
    gives no rows. The same table and seed give the same rows again.
    """
    key = F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))
    rows = stage(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), *[F.col(c).alias(f"_k_{c}") for c in keep],
        key.alias("source_key"), n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_h")), "mix-rows")
    counts = stage(rows.groupBy("source_key", "size").agg(F.count("*").alias("n")), "mix-counts")
    sizes = counts.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = [(F.col("source_key") == "n").asc(), F.col("source_key").asc()]
    targets = stage(source_targets(global_rank(sizes, order, "mix-rank", "source_rank"), weights, share, most), "mix-targets")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        # one source's length counts: lengths that differ, so at most sqrt(2 x its words) rows
        total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        repeats = int(target // total) if total else 0
        group = group.sort_values("size")
        group["extra"] = fit_counts(group["size"], group["n"], round(target - repeats * total),
                                    f"{seed}:{group['source_key'].iloc[0]}")
        return group.assign(repeats=repeats)[["source_key", "size", "n", "source_size", "target", "repeats", "extra"]]

    plan = stage(counts.join(targets.drop("source_rank").hint("merge"), "source_key").groupBy("source_key").applyInPandas(
        fit, "source_key string, size long, n long, source_size long, target double, repeats int, extra long"), "mix-plan")
    # The first `extra` of a length by hash: slots of the hash keep each ranked group near sqrt(n) rows.
    slots = F.ceil(F.sqrt("n")).cast("long")
    dealt = hot_join(rows, plan, ["source_key", "size"], "n", rows.count()).withColumn(
        "_slot", F.floor((F.col("_h").cast("double") / F.lit(2.0 ** 64) + 0.5) * slots).cast("long"))
    part = stage(dealt, "mix-dealt")
    open_ = part.filter("extra > 0 and extra < n")
    before = W.partitionBy("source_key", "size").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    edges = (open_.groupBy("source_key", "size", "_slot").agg(F.count("*").alias("in_slot"))
             .withColumn("seen", F.coalesce(F.sum("in_slot").over(before), F.lit(0))))
    nth = F.row_number().over(W.partitionBy("source_key", "size", "_slot").orderBy("_h", "_id"))
    picked = (open_.withColumn("nth", nth).join(edges.hint("merge"), ["source_key", "size", "_slot"])
              .withColumn("more", (F.col("seen") + F.col("nth") <= F.col("extra")).cast("int"))
              .drop("nth", "in_slot", "seen"))
    whole = part.filter("not (extra > 0 and extra < n)").withColumn("more", (F.col("extra") > 0).cast("int"))
    copies = F.col("repeats") + F.col("more")
    return picked.unionByName(whole).select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), *[F.col(f"_k_{c}").alias(c) for c in keep],
        "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the plan takes it, with the columns of ``docs``. Of rows
    alike in id, text and source one is repeated for all."""
    marked = docs.withColumn("_key", F.concat(row_key(id_col, text_col), F.coalesce(F.col(source_col).cast("binary"), F.lit(b"\xff"))))
    plan = plan_mix(marked, id_col, text_col, source_col, keep=["_key"], **how)
    copies = plan.groupBy("_key").agg(F.sum("copies").cast("int").alias("_copies")).filter("_copies > 0")
    return (marked.dropDuplicates(["_key"]).join(copies.hint("merge"), "_key")
            .withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns))
