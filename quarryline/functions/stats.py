"""Statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ln_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series ten steps up; good to twelve digits."""
    x = n.cast("double") + 11
    series = (x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    product = n.cast("double") + 1
    for k in range(2, 11):
        product = product * (n + k)
    return series - F.ln(product)


def permutation_p(hits_a: Column, n_a: Column, hits_b: Column, n_b: Column) -> Column:
    """One-sided p of a permutation test of two 0/1 samples: the hypergeometric tail, exactly.

    Left out are terms six times sqrt(n_a + 1) from the largest of the tail: the logarithm of the terms bends by at least
    4 / (n_a + 1) a step, so each of them is below exp(-72) of that one, and all together below what a double can tell.
    """
    hits_a, n_a, hits_b, n_b = (c.cast("long") for c in (hits_a, n_a, hits_b, n_b))
    k, n = hits_a + hits_b, n_a + n_b
    choose = lambda a, b: ln_factorial(a) - ln_factorial(b) - ln_factorial(a - b)
    mode = F.floor((n_a + 1).cast("double") * (k + 1).cast("double") / (n + 2).cast("double"))
    far = F.ceil(6 * F.sqrt((n_a + 1).cast("double"))) + 2
    low, high = F.greatest(hits_a, k - n_b, mode - far), F.least(k, n_a, F.greatest(hits_a, mode) + far)
    terms = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + F.exp(choose(n_a, x) + choose(n_b, k - x) - choose(n, k)))


def is_significant(hits_a: Column, n_a: Column, hits_b: Column, n_b: Column, confidence: float = 0.95) -> Column:
    """False for empty samples and where a is not better."""
    product = lambda a, b: a.cast("decimal(19,0)") * b.cast("decimal(19,0)")
    better = (n_a > 0) & (n_b > 0) & (product(hits_a, n_b) > product(hits_b, n_a))
    return F.when(better, permutation_p(hits_a, n_a, hits_b, n_b) < 1 - confidence).otherwise(False)


def early_stop(values: Column, min_delta: float = 0.0, patience: int = 5) -> Column:
    """struct(best, since, stopped_at) over an ordered array: the best moves only by min_delta or more; stop after patience."""
    start = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("since"), F.lit(None).cast("int").alias("stopped_at"), F.lit(0).alias("k"))

    def step(acc: Column, x: Column) -> Column:
        better = acc["best"].isNull() | (x >= acc["best"] + min_delta)
        since = F.when(better, F.lit(0)).otherwise(acc["since"] + 1)
        moved = F.struct(
            F.when(better, x).otherwise(acc["best"]).alias("best"),
            since.alias("since"),
            F.when(since >= patience, acc["k"]).alias("stopped_at"),
            (acc["k"] + 1).alias("k"),
        )
        return F.when(acc["stopped_at"].isNotNull(), acc).otherwise(moved)

    return F.aggregate(values, start, step, lambda acc: F.struct(acc["best"], acc["since"], acc["stopped_at"]))
