"""Every query of the engine by name, with the SQL that checks it."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.plans import agents, codebase, eda, frames, roundtrips, surface, tasks, texts
from quarryline.plans.dialect import DUCK, SPARK, Spark
from quarryline.session import TABLES, sql

TEXTS: dict[str, Callable[[Spark], str]] = tasks.QUERIES | texts.QUERIES


def text(name: str, dialect: Spark) -> str:
    """A query's SQL; numbers marked as doubles are written in a way that both engines read so."""
    return re.sub(r"(\d)D\b", r"\1e0", TEXTS[name](dialect))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query over the tables of a folder; only the tables that it names are opened."""
    return sql(spark, sf_dir, text(name, SPARK))


def widened(query: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query's result with all whole numbers in eight bytes, as the SQL that checks it has them."""
    out = query(spark, sf_dir)
    return out.select(*(F.col(f"`{c}`").cast("long").alias(c) if kind in ("int", "smallint", "tinyint") else F.col(f"`{c}`") for c, kind in out.dtypes))


def wide(sql: str, columns: str) -> str:
    """DuckDB SQL with some columns in eight bytes."""
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in columns.split())}) FROM ({sql}) wide"


#: Columns that DuckDB counts in other widths.
WIDE = {
    "rollout_parts": "gen n_calls n_files", "cv_subset": "fold", "win_early_stop": "since", "task_features": "added deleted churn", "diff_hunk_counting": "hunks", "graph_resolve": "tier",
    "fn_scalars": "number n_items setting", "junit_reports": "skipped",
}
BUILT = {name: functools.partial(widened, query) for name, query in (agents.QUERIES | eda.QUERIES | codebase.QUERIES | surface.QUERIES | roundtrips.QUERIES).items()}
WRITTEN = {name: wide(sql, WIDE[name]) if name in WIDE else sql for name, sql in (agents.ORACLE | eda.ORACLE | codebase.ORACLE | surface.ORACLE | roundtrips.ORACLE).items()}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: functools.partial(run, name) for name in TEXTS} | frames.QUERIES | BUILT
ORACLE: dict[str, str] = {name: text(name, DUCK) for name in TEXTS} | frames.ORACLE | WRITTEN
