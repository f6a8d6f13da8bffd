"""Each query against DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from quarryline.plans.catalogue import ORACLE, QUERIES, TABLES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    cell = lambda v: (v is None, round(v, 6) if isinstance(v, float) and not math.isnan(v) else v)
    return sorted((tuple(cell(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(SF))
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert normal(map(tuple, got.collect()), got.columns) == normal(cursor.fetchall(), names)
