"""Sinks: telemetry, history, registry updates, submissions, deterministic archives."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Kinds of telemetry.
KINDS = ["start", "end", "metric", "info", "reward"]


def telemetry_event(kind: str, run_version: str, payload: Column, at: Column | None = None) -> list[Column]:
    """Columns of a telemetry event; payload is a struct or a map, written as JSON text."""
    if kind not in KINDS:
        raise ValueError(f"no telemetry of kind {kind}")
    stamp = F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return [stamp.alias("timestamp"), F.lit(run_version).alias("run_version"), F.lit(kind).alias("event_type"), F.to_json(payload).alias("payload")]


def append_telemetry(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def config_json(config: object) -> str:
    """A configuration as JSON: mappings as they are, objects by their public attributes, the rest as text."""
    public = lambda x: {k: v for k, v in vars(x).items() if not k.startswith("_")} if hasattr(x, "__dict__") else str(x)
    return json.dumps(config, default=public, sort_keys=True)


def write_results(results: DataFrame, path: str, folders: bool = False) -> None:
    """A run's artefacts: summary (one row), task_results (JSON lines), patches and traces as JSON lines of instance_id and value.

    folders: patches and traces as text files in a folder for each instance, for runs of few tasks.
    """
    resolved = F.coalesce(F.avg(F.col("resolved").cast("double")), F.lit(0.0))
    results.agg(F.count("*").alias("total"), F.count_if("resolved").alias("n_resolved"), resolved.alias("resolution_rate")).write.mode("overwrite").json(f"{path}/summary")
    results.drop("trace").write.mode("overwrite").json(f"{path}/task_results")
    for name, column in (("patches", "patch"), ("traces", "trace")):
        rows = results.where(F.col(column).isNotNull()).select("instance_id", F.col(column).alias("value"))
        if folders:
            rows.write.mode("overwrite").partitionBy("instance_id").text(f"{path}/{name}")
        else:
            rows.write.mode("overwrite").json(f"{path}/{name}")


def released(version: str, what: str, changelog: str, message: str, date: str) -> tuple[str, str]:
    """(next version, changelog with an entry for it)."""
    numbers = [int(x) for x in version.lstrip("v").strip().split(".")]
    if len(numbers) != 3:
        raise ValueError(f"no version: {version}")
    at = ["major", "minor", "patch"].index(what)
    numbers = [*numbers[:at], numbers[at] + 1, *[0] * (2 - at)]
    new = ".".join(map(str, numbers))
    return new, f"{changelog}\n## [v{new}] - {date}\n- {message}\n"


def history_json(history: DataFrame, order: str) -> DataFrame:
    """One row: the history as a JSON array in order. The history is one entry a version, so it is small."""
    entries = F.array_sort(F.collect_list(F.struct(order, *(c for c in history.columns if c != order))))
    return history.agg(F.to_json(entries).alias("json"))


def update_registry(registry: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """All rows of a key take the update's values where it has them; updates' own columns must be the registry's.

    Of several updates of one key the greatest row counts, so no row of the registry is repeated.
    """
    fields = [c for c in updates.columns if c != key]
    updates = updates.groupBy(key).agg(F.max(F.struct(*fields)).alias("x")).select(key, "x.*")
    renamed = updates.select(key, *(F.col(c).alias(f"{c}__new") for c in fields))
    joined = registry.join(renamed, key, "left")
    return joined.select(*(F.coalesce(f"{c}__new", c).alias(c) if c in fields else F.col(c) for c in registry.columns))


def append_registry(registry: DataFrame, added: DataFrame) -> DataFrame:
    """The registry and more rows; columns that a side lacks are null there."""
    return registry.unionByName(added, allowMissingColumns=True)


def write_submission(predictions: DataFrame, path: str) -> None:
    """(id, prediction), with NO_PATCH where there is none."""
    empty = F.coalesce(F.trim("prediction"), F.lit("")) == ""
    predictions.select("id", F.when(empty, "NO_PATCH").otherwise(F.col("prediction")).alias("prediction")).write.mode("overwrite").parquet(path)


def fixed_zip(files: dict[str, bytes]) -> tuple[bytes, str]:
    """A zip whose bytes depend on names and contents alone, and its sha256."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(files):
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), files[name], zipfile.ZIP_DEFLATED)
    return out.getvalue(), hashlib.sha256(out.getvalue()).hexdigest()
