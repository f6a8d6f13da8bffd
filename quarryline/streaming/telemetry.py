"""Telemetry as a stream: windowed counts with a watermark, alerts, and a stateful budget counter."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarryline.session import shared_folder

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
FREE = ("signup",)
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def read_events(spark: SparkSession, folder: str, kind: str = "parquet", schema: str = EVENT) -> DataFrame:
    """A stream of the files that arrive in a folder."""
    return spark.readStream.format(kind).schema(schema).load(folder)


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Events and their values by window and type; windows begin every slide, or follow each other; later events than late are left out."""
    groups = events.withWatermark("ts", late).groupBy(F.window("ts", window, slide), "event_type")
    out = groups.agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


def sessions(events: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events that are less than gap apart; end is gap after the last one."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    out = events.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def stops(metrics: DataFrame, least: float = 0.01, patience: int = 5) -> DataFrame:
    """(run, best, waited, stopped) after each batch of metrics (run, step, value): early stopping in the stream's state.

    The best moves by least or more; patience steps in a row without that stop the run for good. A batch's rows of a run are
    taken by step.
    """

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, waited, stopped = state.get if state.exists else (None, 0, False)
        rows = pd.concat(list(batches)).sort_values("step")
        for value in rows["value"]:
            if stopped:
                break
            if best is None or value >= best + least:
                best, waited = float(value), 0
            else:
                waited += 1
                stopped = waited >= patience
        state.update((best, waited, stopped))
        yield pd.DataFrame({"run": [key[0]], "best": [best], "waited": [waited], "stopped": [stopped]})

    return metrics.groupBy("run").applyInPandasWithState(watch, "run long, best double, waited long, stopped boolean", "best double, waited long, stopped boolean", "update", GroupStateTimeout.NoTimeout)


def timeouts(events: DataFrame, after: str = "1 hour") -> DataFrame:
    """(user_id, n, ended): users' events so far, and those whose last event lies longer back than after; by event time."""

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            n = state.get[0]
            state.remove()
            yield pd.DataFrame({"user_id": [key[0]], "n": [n], "ended": [True]})
            return
        n, latest = state.get if state.exists else (0, 0)
        for batch in batches:
            n += len(batch)
            latest = max(latest, int(batch.ts.max().timestamp() * 1000))
        state.update((n, latest))
        state.setTimeoutTimestamp(max(latest + span, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "ended": [False]})

    span = int(pd.Timedelta(after).total_seconds() * 1000)
    return events.withWatermark("ts", "0 seconds").groupBy("user_id").applyInPandasWithState(count, "user_id long, n long, ended boolean", "n long, latest long", "update", GroupStateTimeout.EventTimeTimeout)


def gap_alerts(metrics: DataFrame, limit: float = 0.15) -> DataFrame:
    """Metric rows whose local and public scores are more than limit apart."""
    gap = F.abs(F.col("cv_score") - F.col("lb_score"))
    return metrics.withColumn("gap", gap).where(F.col("gap") > limit)


def budget_status(events: DataFrame, most: int = 100, warn_used: int = 20, warn_left: int = 10, free: tuple[str, ...] = FREE) -> DataFrame:
    """(user_id, used, remaining, warns) after each batch: a counter per user in the stream's state, free events not counted."""

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        used = state.get[0] if state.exists else 0
        for batch in batches:
            used += int((~batch.event_type.isin(free)).sum())
        state.update((used,))
        left = max(0, most - used)
        yield pd.DataFrame({"user_id": [key[0]], "used": [used], "remaining": [left], "warns": [used >= warn_used and left <= warn_left]})

    return events.groupBy("user_id").applyInPandasWithState(count, "user_id long, used long, remaining long, warns boolean", "used long", "update", GroupStateTimeout.NoTimeout)


def drained(stream: DataFrame, mode: str, arrivals: Sequence[Callable[[], None]] = ()) -> DataFrame:
    """All that a stream gives for the input there is, as a table in the shared folder: in complete mode its last state, else every batch.

    The state and the offsets lie beside it, so a run that is broken off goes on where it stood. arrivals: calls that bring in
    more input, one batch each, whatever the number and age of its files: the stream goes on from its state after each, and runs a
    batch without input only after the last.
    """
    spark = stream.sparkSession
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    keep = "overwrite" if mode == "complete" else "append"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    writer = writer.foreachBatch(lambda batch, _: batch.write.mode(keep).parquet(f"{base}/table"))
    before = spark.conf.get(NO_DATA)
    try:
        for k, arrive in enumerate([lambda: None, *arrivals]):
            arrive()
            spark.conf.set(NO_DATA, "false" if k < len(arrivals) else before)
            writer.start().awaitTermination()
    finally:
        spark.conf.set(NO_DATA, before)
    return spark.read.schema(stream.schema).parquet(f"{base}/table")
