"""Streaming sliding-window totals (T2) with event time and a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import policies
from ..operators.aggregates import guarded_mean, sliding_arm_stream, sliding_arm_totals
from ..sources.topics import write_batch


def sliding_stream(updates: DataFrame, window: str, slide: str, watermark: str, ts: str = "ts") -> DataFrame:
    """A2 on a stream: late rows older than the watermark are dropped, window state expires.
    ``updates`` carries ``ts`` (TIMESTAMP, not NTZ), ``group_id``, ``decision``, ``cost``."""
    return sliding_arm_stream(updates.withWatermark(ts, watermark), window, slide, ts=ts)



class EpsilonGreedyStream:
    """Epsilon-greedy decision maker on a stream: window totals -> best and other options -> one JSON decision.

    A window's totals leave the stateful aggregate together, once the watermark has passed its end; the batch
    that gets them decides per (window, group). ``seed`` is the warm start: historic updates ``(group_id,
    decision, cost, ts, weight)`` that stand for ``weight`` updates each and count in the windows their time lies in.
    Each batch writes its own folder, so a replayed batch rewrites its decisions.
    """

    KEYS = ("window_start", "group_id", "decision")

    def __init__(self, spark: SparkSession, root: str, epsilon: float, origin: str, window: str, slide: str,
                 watermark: str, seed: DataFrame | None = None):
        self.spark, self.epsilon, self.origin = spark, epsilon, origin
        self.window, self.slide, self.watermark = window, slide, watermark
        self.out = f"{root.rstrip('/')}/decisions"
        self.seed = None if seed is None else sliding_arm_totals(seed, window, slide, weight="weight")

    def process(self, totals: DataFrame, batch_id: int) -> None:
        totals = totals.select(*self.KEYS, "score_sum", "cnt")
        if self.seed is not None:
            windows = totals.select("window_start").distinct()
            seeded = self.seed.join(windows, "window_start", "left_semi").select(*self.KEYS, "score_sum", "cnt")
            totals = totals.unionByName(seeded).groupBy(*self.KEYS).agg(
                F.sum("score_sum").alias("score_sum"), F.sum("cnt").alias("cnt"))
        best = policies.best_arm(totals.withColumn("mean_score", guarded_mean("score_sum", "cnt")), keys=("window_start", "group_id"))
        write_batch(best.select("window_start", "group_id", "best", policies.eg_message(best, self.epsilon, self.origin).alias("message")),
                    self.out, batch_id)

    def start(self, updates: DataFrame, checkpoint: str, trigger: dict | None = None):
        totals = sliding_stream(updates, self.window, self.slide, self.watermark)
        w = totals.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(self.process)
        return w.trigger(**(trigger or {"availableNow": True})).start()

    def decisions(self) -> DataFrame:
        return self.spark.read.parquet(self.out).drop("batch_id")
