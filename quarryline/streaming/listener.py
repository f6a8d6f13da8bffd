"""What streams do, as a table: callbacks at their start, after each batch and at their end."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quarryline.session import shared_folder

ROW = "event string, query_id string, run_id string, name string, batch_id long, input_rows long, duration_ms long, state_rows long, late_rows long, at string, error string"


class ProgressTable(StreamingQueryListener):
    """Writes a row for each event of the session's streams to a table, and calls what is given for them.

    on_batch gets each batch's row as a dict, on_end the last one's; an exception in them is noted in the row's error, and neither
    the stream nor the other rows are lost. Rows of a driver that ends are in the table already: each is a file of its own.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, on_batch: Callable[[dict], None] | None = None, on_end: Callable[[dict], None] | None = None) -> None:
        super().__init__()
        self.spark, self.path, self.calls = spark, path or f"{shared_folder(spark)}/progress-{uuid.uuid4().hex}", {"batch": on_batch, "end": on_end}

    def _write(self, event: str, **values: object) -> None:
        row = {k: None for k in (c.split()[0] for c in ROW.split(", "))} | {"event": event} | values
        if call := self.calls.get(event):
            try:
                call(dict(row))
            except Exception as error:  # noqa: BLE001
                row["error"] = f"{type(error).__name__}: {error}"
        self.spark.createDataFrame([tuple(row.values())], ROW).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        self._write("start", query_id=str(event.id), run_id=str(event.runId), name=event.name, at=event.timestamp)

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        p = json.loads(event.progress.json)
        state = p.get("stateOperators") or []
        self._write(
            "batch", query_id=p["id"], run_id=p["runId"], name=p.get("name"), batch_id=p["batchId"], input_rows=sum(s["numInputRows"] for s in p["sources"]), duration_ms=p.get("batchDuration"),
            state_rows=sum(s["numRowsTotal"] for s in state), late_rows=sum(s.get("numRowsDroppedByWatermark", 0) for s in state), at=p["timestamp"],
        )

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self._write("end", query_id=str(event.id), run_id=str(event.runId), error=event.exception)

    def rows(self) -> DataFrame:
        """The table so far; batches of the same number from restarts once, the latest of each run."""
        return self.spark.read.schema(ROW).parquet(self.path)


def batches(progress: DataFrame) -> DataFrame:
    """(query_id, batch_id, input_rows, state_rows, late_rows): each batch of each stream once, whatever was run again."""
    rows = progress.where("event = 'batch' and input_rows > 0")
    latest = F.struct("at", "input_rows", "state_rows", "late_rows")
    return rows.groupBy("query_id", "batch_id").agg(F.max(latest).alias("x")).select("query_id", "batch_id", "x.input_rows", "x.state_rows", "x.late_rows")
