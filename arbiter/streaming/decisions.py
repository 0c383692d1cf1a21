"""Streaming decision maker and heartbeats on keyed state with timers.

A group's arms, the totals of its open epochs and the number of its next epoch lie in Spark's keyed
streaming state. Epochs are event time. One timer per group stands at the end of its next epoch; when the watermark has passed
it, every epoch up to the watermark is closed in order: ``S = x + gamma * S`` for all known arms, idle
ones too, so silent epochs decay and are emitted like the others. The results are those of the batch fold
(:mod:`operators.discount`), whatever the micro-batches were, and go on after a restart from the checkpoint.

Heartbeats use processing-time timers: they go on while nothing arrives.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..adapters import COST_SCALE, EPOCH_BASE_US, EPOCH_WIDTH_US, exact
from ..functions.parsing import decision_message
from ..operators import policies
from ..sources.topics import write_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_ROWS = "kind string, group_id string, decision string, epoch long, score_sum double, cnt double"
EPOCHS_AT_ONCE = 512  # closed epochs handed on in one piece


def use_keyed_state(spark: SparkSession) -> None:
    """Timers and keyed maps need the RocksDB state store; its files lie under the query's checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class ArmState(StatefulProcessor):
    """One group: discounted totals of its arms, closed epoch by epoch.

    Input columns: decision, units (the cost times 10 ** COST_SCALE, a long), epoch; none is null, as ``parse_updates`` sees to.
    A row for an epoch that the watermark has passed comes out as kind ``late``; the others of kind ``state``, one per
    arm and closed epoch. Open epochs are those between the watermark and the newest update.
    """

    def __init__(self, gamma: float, base_us: int, width_us: int, reset_period: int | None):
        self.gamma, self.base_us, self.width_us, self.reset = gamma, base_us, width_us, reset_period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "epoch long")
        self.arms = handle.getMapState("arms", "decision string", "s double, c double")
        # sums of costs as the text of whole numbers: exact, of any size
        self.open = handle.getMapState("open", "epoch long, decision string", "units string, n long")

    def _end_ms(self, epoch: int) -> int:
        return -(-(self.base_us + (epoch + 1) * self.width_us) // 1000)

    def _add(self, epoch: int, decision: str, units: int, n: int) -> None:
        key = (epoch, decision)
        if self.open.containsKey(key):
            old = self.open.getValue(key)
            units, n = units + int(old[0]), n + old[1]
        self.open.updateValue(key, (str(units), n))

    def _start(self, epoch: int) -> None:
        """The next epoch to close. An earlier one that is still open may come up, so it can move back."""
        self.next.update((epoch,))
        self.handle.registerTimer(self._end_ms(epoch))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        known = first = self.next.get()[0] if self.next.exists() else None
        for batch in rows:
            for (epoch, decision), part in batch.groupby(["epoch", "decision"])["units"]:
                epoch = int(epoch)
                if self._end_ms(epoch) <= mark:
                    yield pd.DataFrame({"kind": "late", "group_id": key[0], "decision": decision, "epoch": epoch,
                                        "score_sum": [-u / 10 ** COST_SCALE for u in part], "cnt": 1.0})
                    continue
                self._add(epoch, decision, sum(map(int, part)), len(part))
                first = epoch if first is None else min(first, epoch)
        if first != known:
            self._start(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark, at = timerValues.getCurrentWatermarkInMs(), self.next.get()[0]
        if self._end_ms(at) > mark:
            return  # the timer of an epoch that an earlier one has closed with it
        arms = {k[0]: (v[0], v[1]) for k, v in self.arms.iterator()}
        totals: dict[int, dict[str, tuple[float, float]]] = {}
        for (epoch, decision), (units, n) in list(self.open.iterator()):
            if self._end_ms(epoch) <= mark:
                totals.setdefault(epoch, {})[decision] = (float(Decimal(-int(units)).scaleb(-COST_SCALE)), float(n))
                self.open.removeKey((epoch, decision))
        out: list[tuple] = []
        while self._end_ms(at) <= mark:
            new = totals.get(at, {})
            for decision in arms.keys() | new.keys():
                x, old = new.get(decision), arms.get(decision)
                if x is None:
                    arms[decision] = (old[0] * self.gamma, old[1] * self.gamma)
                elif old is None:
                    arms[decision] = x
                else:
                    arms[decision] = (x[0] + old[0] * self.gamma, x[1] + old[1] * self.gamma)
            out += [("state", key[0], d, at, s, c) for d, (s, c) in arms.items()]
            if self.reset and (at + 1) % self.reset == 0:
                arms = {}
            at += 1
            if at % EPOCHS_AT_ONCE == 0 and out:
                yield pd.DataFrame(out, columns=[f.split()[0] for f in STATE_ROWS.split(", ")])
                out = []
        self.arms.clear()
        for decision, state in arms.items():
            self.arms.updateValue((decision,), state)
        self._start(at)
        if out:
            yield pd.DataFrame(out, columns=[f.split()[0] for f in STATE_ROWS.split(", ")])

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        """Warm start: historic totals count in their epoch like updates."""
        for r in initialState.itertuples(index=False):
            self._add(int(r.epoch), r.decision, int(r.units), int(r.n))
        first = int(initialState["epoch"].min())
        self._start(min(first, self.next.get()[0]) if self.next.exists() else first)

    def close(self) -> None:
        pass


class DecisionStream:
    """Updates ``(ts, group_id, decision, cost)`` to the state of every arm and a schedule per group, for every epoch.

    ``root`` gets ``state`` (S20), ``decisions`` and ``late`` (dead letters: rows of closed epochs), a folder per micro-batch, written
    with overwrite, so that a replayed batch rewrites its own output only. An epoch is emitted once the watermark has passed its end;
    what a silent stretch held is emitted, decayed, with the first batch after it. ``reset_period``: the last
    epoch of each period emits ``random`` and the arms start anew. ``seed``: warm-start rows
    ``(group_id, decision, epoch, cost, n)``: ``n`` historic updates that cost ``cost`` together, the initial state of the groups.
    """

    def __init__(self, spark: SparkSession, root: str, gamma: float, picks: int, origin: str,
                 reset_period: int | None = None, seed: DataFrame | None = None, watermark: str = "0 seconds",
                 base_us: int = EPOCH_BASE_US, width_us: int = EPOCH_WIDTH_US):
        self.spark, self.gamma, self.picks, self.origin, self.reset = spark, gamma, picks, origin, reset_period
        self.seed, self.watermark, self.base_us, self.width_us = seed, watermark, base_us, width_us
        base = root.rstrip("/")
        self.state, self.out, self.late = f"{base}/state", f"{base}/decisions", f"{base}/late"

    def states(self, updates: DataFrame) -> DataFrame:
        """The stream of STATE_ROWS. The time itself isn't handed on: Spark would drop late rows, which are dead letters here."""
        use_keyed_state(self.spark)
        units = (exact("cost") * 10 ** COST_SCALE).cast("long")
        epoch = F.floor((F.unix_micros("ts") - self.base_us) / self.width_us).cast("long")
        rows = updates.withWatermark("ts", self.watermark).select("group_id", "decision", units.alias("units"), epoch.alias("epoch"))
        start = None
        if self.seed is not None:
            start = self.seed.select("group_id", "decision", F.col("epoch").cast("long").alias("epoch"),
                                     (exact("cost") * 10 ** COST_SCALE).cast("long").alias("units"),
                                     F.col("n").cast("long").alias("n")).groupBy("group_id")
        return rows.groupBy("group_id").transformWithStateInPandas(
            ArmState(self.gamma, self.base_us, self.width_us, self.reset), STATE_ROWS, "Append", "EventTime", initialState=start)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body: all arms of a group's epoch come in one batch, so its schedule can be made here."""
        batch = batch.persist()
        write_batch(batch.where("kind = 'late'").select("group_id", "decision", "epoch", (-F.col("score_sum")).alias("cost")), self.late, batch_id)
        states = batch.where("kind = 'state'").drop("kind")
        write_batch(states, self.state, batch_id)
        made = policies.ucb_schedule(states, self.picks, self.gamma)
        payload = policies.reset_payload(F.col("schedule"), F.col("epoch"), self.reset) if self.reset else F.col("schedule")
        write_batch(made.select("epoch", "group_id", payload.alias("payload"))
                    .withColumn("message", decision_message(F.col("group_id"), F.col("payload"), self.origin)), self.out, batch_id)
        batch.unpersist()

    def start(self, updates: DataFrame, checkpoint: str, trigger: dict | None = None):
        w = self.states(updates).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(self.process)
        return w.trigger(**(trigger or {"availableNow": True})).start()

    def decisions(self) -> DataFrame:
        return self.spark.read.parquet(self.out).drop("batch_id")

    def state_rows(self) -> DataFrame:
        return self.spark.read.parquet(self.state).drop("batch_id")

    def late_rows(self) -> DataFrame:
        return self.spark.read.parquet(self.late).drop("batch_id")


class Heartbeat(StatefulProcessor):
    """One cluster: a beat when its first row arrives and one per interval from then on, with or without input."""

    def __init__(self, interval_ms: int):
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.beats = handle.getValueState("beats", "n long, records long")

    def _beat(self, key, n: int, records: int, now: int) -> pd.DataFrame:
        return pd.DataFrame({"cluster_id": [key[0]], "beat": [n], "at_ms": [now], "n_records": [records]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        seen, now = sum(map(len, rows)), timerValues.getCurrentProcessingTimeInMs()
        if self.beats.exists():
            n, records = self.beats.get()
            self.beats.update((n, records + seen))
        else:
            self.beats.update((1, 0))
            self.handle.registerTimer(now + self.interval_ms)
            yield self._beat(key, 0, seen, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, records = self.beats.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        self.beats.update((n + 1, 0))
        self.handle.registerTimer(max(now, expiredTimerInfo.getExpiryTimeInMs()) + self.interval_ms)
        yield self._beat(key, n, records, now)

    def close(self) -> None:
        pass


def heartbeats(stream: DataFrame, interval_ms: int, cluster: str = "cluster_id") -> DataFrame:
    """``(cluster_id, beat, at_ms, n_records)``: numbered beats per cluster seen in ``stream``, and the records since the beat
    before. They go on while nothing arrives; run the query with a processing-time trigger."""
    use_keyed_state(stream.sparkSession)
    return stream.select(F.col(cluster).alias("cluster_id")).groupBy("cluster_id").transformWithStateInPandas(
        Heartbeat(interval_ms), "cluster_id string, beat long, at_ms long, n_records long", "Append", "ProcessingTime")
