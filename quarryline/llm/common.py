"""What the operators of this subpackage share: inputs, the shared work folder and written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a lazy scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quarryline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_open: list[list[str]] = []


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: a table that outlives lost executors and cuts the lineage.

    Inside temporary_tables it is deleted at the end, unless it is to be kept.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _open and not keep:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are written while this lasts, but for kept ones; what it returns must not read them."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small_side(df: DataFrame, rows: int = 1 << 18) -> DataFrame:
    """A written table as a side to broadcast if it has at most so many rows, all of numbers; else as it is, for a shuffled join.

    Rows of up to four numbers of eight bytes come to 8 MB at most.
    """
    narrow = len(df.columns) <= 4 and all(kind in ("bigint", "int", "tinyint", "double", "boolean") for _, kind in df.dtypes)
    return F.broadcast(df) if narrow and df.count() <= rows else df


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches to Python hold at most so many rows while this lasts; for rows that may be wide."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def hashed_sample(df: DataFrame, by: list[str], size: int) -> DataFrame:
    """About size rows of df, different in some columns: those whose hash of them lies below a limit. No row order matters.

    Equal rows count as one, so a large group of copies gives one row at most.
    """
    share = max(1, df.count()) / size
    cut = F.pmod(F.xxhash64(*by), F.lit(1 << 30)) < int((1 << 30) / max(1.0, share)) + (share <= 1)
    return df.where(cut).dropDuplicates(by)
