import random

import numpy as np
import pytest

from quarryline.operators import folds, quantiles, retrieval
from quarryline.sources import readers


def test_quantiles_of_any_distribution(spark):
    rng = random.Random(5)
    groups = {"normal": [rng.gauss(0, 1) for _ in range(3000)], "same": [7.0] * 2500, "wide": [10.0 ** rng.randrange(-200, 300) for _ in range(400)], "one": [3.5], "two": [1.0, 2.0], None: [float(k % 5) for k in range(1000)], "ends": [-1.7e308, 1.7e308, 0.0]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("normal", None), ("normal", float("nan")), ("empty", None)]
    rng.shuffle(rows)
    got = quantiles.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()
    assert len(got) == 5 * len(groups)
    for r in got:
        values = sorted(groups[r.g])
        at = r.share * (len(values) - 1)
        low, high = values[int(at)], values[min(len(values) - 1, int(np.ceil(at)))]
        assert r.quantile == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12)


def test_places_and_positions(spark):
    left = spark.createDataFrame([(k, f"t{k}") for k in (5, 1, 9, 3)], "a long, t string")
    right = spark.createDataFrame([(k,) for k in (20, 10, 30)], "b long")
    assert sorted(map(tuple, retrieval.positional(left, right, "a", "b").collect())) == [(1, "t1", 10), (3, "t3", 20), (5, "t5", 30)]
    assert [r.n for r in retrieval.numbered(left, "a", "n").orderBy("a").collect()] == [0, 1, 2, 3]


def test_folds_that_are_not_there_raise(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "k long, fold long")
    train, own = folds.fold_at(rows, 1)
    assert (train.count(), own.count()) == (2, 1)
    for fold in (-1, 2):
        with pytest.raises(IndexError):
            folds.fold_at(rows, fold)


def test_vectors_of_a_missing_path(spark, tmp_path):
    assert readers.vectors(spark, str(tmp_path / "none")).collect() == []
