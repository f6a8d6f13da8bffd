import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import negatives
from quarryline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    kept = []
    for vec, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        kept.append((vec, (label + 1) % 10 if vec is not None and vec % 7 == 0 else label, [math.floor(256 * c) for c in x]))
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    out = []
    for k, (vec, label, x) in enumerate(kept):
        if vec is None or vec % 100:
            continue
        others = [(-dot(x, y), float("inf") if v is None else v, v, own) for j, (v, own, y) in enumerate(kept) if j != k]
        for p, _, positive, _ in sorted((o for o in others if o[3] == label), key=lambda o: o[:2])[:5]:
            hard = sorted((o for o in others if o[3] != label and -30 * p <= -100 * o[0] <= -90 * p), key=lambda o: o[:2])[:10]
            out += [(vec, positive, rank, o[2], -p, -o[0]) for rank, o in enumerate(hard, 1)]
    return out


def mined(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "2 as page", "3 as v_")
    own = negatives.quantised(docs, "embedding").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    out = negatives.hard_negatives(own, F.col("vec_id") % 100 == 0, **kw).collect()
    return sorted((tuple((v is None, v) for v in r) for r in out))


def key(rows):
    return sorted(tuple((v is None, v) for v in r) for r in rows)


@pytest.mark.parametrize(("page", "block", "near"), [(4096, 512, 8), (16, 3, 2)])
def test_against_brute_force(spark, page, block, near):
    rng = np.random.default_rng(page)
    centres = rng.normal(size=(6, 12))
    rows = []
    for k in range(900):
        label = int(rng.integers(0, 6))
        rows.append((k, [float(c) for c in np.float32(0.6 * centres[label] + rng.normal(size=12) * 0.5)], label))
    rows += [(2000, None, 1), (2100, [1.0] * 12, None), (2200, [1.0, None] * 6, 1), (2300, [float("nan")] * 12, 2), (2400, [float("inf")] * 12, 2), (2500, [0.0] * 12, 9), (2600, [1.0] * 12, 8)]
    assert mined(spark, rows, page=page, block=block, near=near) == key(brute(rows))


def test_ties_and_few_candidates(spark):
    """A third of all rows share one vector; one label has a row, another two; vectors with negative scores only."""
    rng = random.Random(4)
    same = [0.5, -0.25, 0.125]
    rows = [(k, same if k % 3 == 0 else [rng.choice([-0.5, 0.0, 0.5]) for _ in range(3)], k % 4) for k in range(500)]
    rows += [(1000, [-9.0, 0.0, 0.0], 7), (1001, [9.0, 0.0, 0.0], 7), (1100, [0.1, 0.2, 0.3], 6), (-100, [0.5, 0.5, 0.5], 1)]
    rng.shuffle(rows)
    assert mined(spark, rows, page=32, block=4, near=2) == key(brute(rows))


def test_odd_rows(spark):
    """Rows without vec_id, vectors of different length, an empty vector, values too large for a score."""
    rows = [(0, [1.0, 1.0], 1), (None, [1.0, 0.9], 1), (1, [0.5], 2), (None, [0.5, 0.1], 2), (2, [], 2), (3, [0.6, 0.3], 2), (200, [], 3)]
    assert mined(spark, rows) == key(brute(rows))
    assert mined(spark, [*rows, (4, [3e38, 1.0], 2), (300, [1e30], 1)]) == key(brute(rows))
    large = [(k, [float(2.0**20 + k), float(2.0**19 - 3 * k)], k % 3) for k in range(0, 400, 4)]
    assert mined(spark, large) == key(brute(large))


def test_repeated_rows_and_empty_table(spark):
    rows = [(k, [float(k % 5), 1.0, 0.2 * (k % 3)], k % 2) for k in range(120)]
    assert mined(spark, rows + rows[:110]) == key(brute(rows + rows[:110]))
    assert mined(spark, []) == []


def test_key_intervals_leave_pages_out(spark):
    """Well-parted groups: distances leave out most pages, and results are those of a full search."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8)) * 3
    rows = [(k, [float(c) for c in np.float32(centres[k % 12] + rng.normal(size=8) * 0.05)], k % 2) for k in range(1200)]
    assert mined(spark, rows, page=25, block=4, near=1, pivots=12) == key(brute(rows))


def test_query_on_the_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert key(QUERIES["op12_hard_negatives"](spark, sf).collect()) == key(brute(rows))
