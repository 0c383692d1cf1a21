"""Arrival gaps and acknowledgement blocks on a stream (W6, A23), on keyed state.

Per source the state holds the last arrival, the number of arrivals and the last one of the block before, so
the results are those of the batch forms wherever the micro-batches are cut. Arrivals of a source come in time order from batch
to batch; inside a batch they are sorted. A source's arrivals of one batch are one task's work: gaps are sequential.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .decisions import use_keyed_state

ARRIVALS = "kind string, source string, id long, total long, secs double"


class ArrivalState(StatefulProcessor):
    """Input columns: id, ts_us. Kind ``gap``: one row per arrival but a source's first. Kind ``block``: one per ``block`` arrivals."""

    def __init__(self, block: int):
        self.block = block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n long, last long, mark long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values(["ts_us", "id"], kind="stable")
        t = batch["ts_us"].to_numpy(np.int64)
        n, last, mark = self.seen.get() if self.seen.exists() else (0, int(t[0]), int(t[0]))
        gap = np.diff(t, prepend=last) / 1e6
        order = n + 1 + np.arange(len(t))
        gaps = pd.DataFrame({"kind": "gap", "source": key[0], "id": batch["id"].to_numpy(), "total": order, "secs": gap})
        yield gaps[1:] if n == 0 else gaps
        ends = t[order % self.block == 0]
        if len(ends):
            yield pd.DataFrame({"kind": "block", "source": key[0], "id": None, "total": order[order % self.block == 0],
                                "secs": np.diff(ends, prepend=mark) / 1e6}).astype({"id": "Int64"})
            mark = int(ends[-1])
        self.seen.update((int(order[-1]), int(t[-1]), mark))

    def close(self) -> None:
        pass


def arrivals(stream: DataFrame, block: int, source: str = "source", id_col: str = "id", ts_us: str = "ts_us") -> DataFrame:
    """``(kind, source, id, total, secs)``: the gap before each arrival (``total`` its number), and the time that each full
    block of ``block`` arrivals took (``total`` arrivals by its end). Rows without a source or time aren't arrivals."""
    use_keyed_state(stream.sparkSession)
    rows = stream.select(F.col(source).alias("source"), F.col(id_col).cast("long").alias("id"), F.col(ts_us).cast("long").alias("ts_us"))
    return rows.where("source is not null and ts_us is not null").groupBy("source").transformWithStateInPandas(
        ArrivalState(block), ARRIVALS, "Append", "None")
