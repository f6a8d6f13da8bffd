"""Time limits in processing time: a state with timers per key, which ends by itself even when no more events come."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "user_id long, n long, elapsed_ms long, status string"


class TimeLimit(StatefulProcessor):
    """Counts a key's events from its first one on; limit_ms after that a timer ends it, and later events are late.

    The state is dropped by its time to live, keep_ms after the last change: then the key may start anew.
    """

    def __init__(self, limit_ms: int, keep_ms: int) -> None:
        self.limit_ms, self.keep_ms = limit_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "began long, n long, ended boolean", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        now, new = timerValues.getCurrentProcessingTimeInMs(), sum(len(batch) for batch in rows)
        if self.state.exists():
            began, n, ended = self.state.get()
        else:
            began, n, ended = now, 0, False
            self.handle.registerTimer(now + self.limit_ms)
        n += 0 if ended else new
        self.state.update((began, n, ended))
        yield self.row(key, n, now - began, "late" if ended else "running")

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        if self.state.exists():
            began, n, _ = self.state.get()
            self.state.update((began, n, True))
            yield self.row(key, n, timerValues.getCurrentProcessingTimeInMs() - began, "timed out")

    def row(self, key: tuple, n: int, elapsed: int, status: str) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [int(key[0])], "n": [int(n)], "elapsed_ms": [int(elapsed)], "status": [status]})

    def close(self) -> None:
        pass


def time_limits(events: DataFrame, limit_ms: int, keep_ms: int = 86_400_000) -> DataFrame:
    """(user_id, n, elapsed_ms, status) after each batch and at each end: events of users who have limit_ms from their first one.

    status is running, timed out (once, at the limit, with or without events) or late. Needs the RocksDB state store, which is set
    for the session; state and timers lie in the query's checkpoint and outlast restarts, after which timers that are over fire with
    the first batch.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return events.groupBy("user_id").transformWithStateInPandas(TimeLimit(limit_ms, keep_ms), OUT, "Update", "processingTime")
