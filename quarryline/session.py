"""Session settings shared by tests, bench and scripts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(app: str = "quarryline", cpus: str | None = None, partitions: int = 8) -> SparkSession:
    """A local session with the settings that the queries assume: UTC, AQE and skew handling on."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRYLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, as a lazy scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quarryline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A query over the tables of a folder; only the tables that it names are opened. 1.0D is a double in both engines' texts."""
    for t in TABLES:
        if re.search(rf"\b{t}\b", text):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(text)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, whatever reads it and whichever executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str, rows: int = 20_000, tasks_of: DataFrame | None = None) -> DataFrame:
    """df dealt out by key, about so many rows (of tasks_of, if that is cheaper to count) a task: few bytes would else be a task or two, however much is made of a row."""
    return df.repartition((df if tasks_of is None else tasks_of).count() // rows + 1, key)


def small_side(df: DataFrame, rows: int = 1 << 17) -> DataFrame:
    """A stored table as a side to broadcast if it has at most so many rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
