"""A permutation test of real-valued samples as one mergeable pass over blocks of rows.

Every draw deals the treated labels anew over all rows. How many of them fall to a block is drawn along a tree over the blocks,
from its root to the block, by the hypergeometric law; which rows of the block they are is a random order of its values.
Random numbers come from counters (seed and place in the tree), so each task draws its own without seeing another's, the
sums over blocks add up to a true permutation for each draw, and the result does not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRAWS, SEED, BLOCK, MOST_BLOCKS, AT_ONCE = 10_000, 42, 2048, 1 << 16, 1 << 20


def counters(seed: int, place: int) -> np.random.Generator:
    """The random numbers of one place: the same wherever they are drawn."""
    return np.random.Generator(np.random.Philox(key=[seed, place]))


def labels_of_block(sizes: np.ndarray, block: int, treated: int, draws: int, seed: int) -> np.ndarray:
    """For each draw how many treated labels fall to a block: they are parted from the root of a tree over all blocks down to it."""
    before = np.append(0, np.cumsum(sizes))
    low, high, place, labels = 0, len(sizes), 1, np.full(draws, treated, np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left, right = before[middle] - before[low], before[high] - before[middle]
        drawn = counters(seed, place).hypergeometric(left, right, labels)
        low, high, place, labels = (low, middle, 2 * place, drawn) if block < middle else (middle, high, 2 * place + 1, labels - drawn)
    return labels


def treated_sums(values: np.ndarray, labels: np.ndarray, block: int, seed: int) -> np.ndarray:
    """For each draw the sum of so many of the block's values in random order."""
    random, out = counters(seed, (1 << 40) + block), np.empty(len(labels))
    step = max(1, AT_ONCE // max(1, len(values)))
    for k in range(0, len(labels), step):
        part = labels[k : k + step]
        mixed = random.permuted(np.tile(values, (len(part), 1)), axis=1)
        sums = np.column_stack([np.zeros(len(part)), np.cumsum(mixed, axis=1)])
        out[k : k + step] = sums[np.arange(len(part)), part]
    return out


def permutation_test(rows: DataFrame, key: str, value: str, treated: Column, confidence: float = 0.95, draws: int = DRAWS, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """One row (n_treated, n_control, difference, p, significant): do treated rows have a higher mean of value than the others?

    p is the share of draws whose difference of means reaches the observed one. As in the closed form for 0/1 samples, an
    empty sample or a difference that is not above zero is not significant, and its p is null. Rows without value or label take
    no part. Blocks are made by a hash of the key and hold about block rows, more where there would be over MOST_BLOCKS; their
    sizes are all that goes to the driver.
    """
    known = rows.select(F.col(key).alias("key"), F.col(value).cast("double").alias("value"), treated.alias("treated")).where("value is not null and not isnan(value) and treated is not null")
    n, n_treated, total, own = known.agg(F.count("*"), F.count_if("treated"), F.sum("value"), F.sum(F.when(F.col("treated"), F.col("value")))).first()
    spark, schema = rows.sparkSession, "n_treated long, n_control long, difference double, p double, significant boolean"
    n_control = n - n_treated
    if not n_treated or not n_control:
        return spark.createDataFrame([(n_treated, n_control, None, None, False)], schema)
    mean = lambda a: a / n_treated - (total - a) / n_control
    if mean(own) <= 0:
        return spark.createDataFrame([(n_treated, n_control, mean(own), None, False)], schema)
    blocks = max(1, min(MOST_BLOCKS, -(-n // block)))
    dealt = known.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("long").alias("block"), "key", "value")
    sizes = np.zeros(blocks, np.int64)
    for r in dealt.groupBy("block").agg(F.count("*").alias("n")).collect():  # at most MOST_BLOCKS numbers
        sizes[r.block] = r.n

    def sums(group: pd.DataFrame) -> pd.DataFrame:
        at = int(group.block.iloc[0])
        values = group.sort_values(["key", "value"]).value.to_numpy()
        return pd.DataFrame({"sums": [treated_sums(values, labels_of_block(sizes, at, n_treated, draws, seed), at, seed)]})

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.zeros(draws)
        for batch in batches:
            whole += np.sum([np.asarray(x) for x in batch.sums], axis=0)
        yield pd.DataFrame({"draw": np.arange(draws), "sum": whole})

    parts = dealt.groupBy("block").applyInPandas(sums, "sums array<double>").mapInPandas(merged, "draw long, sum double")
    drawn = parts.groupBy("draw").agg(F.sum("sum").alias("a"))
    slack = 1e-9 * (1 + abs(mean(own)))  # sums may be added in any order
    share = F.avg((F.col("a") / n_treated - (F.lit(total) - F.col("a")) / n_control >= mean(own) - slack).cast("double"))
    out = drawn.agg(share.alias("p"))
    return out.select(F.lit(n_treated).cast("long").alias("n_treated"), F.lit(n_control).cast("long").alias("n_control"), F.lit(float(mean(own))).alias("difference"), "p", (F.col("p") < 1 - confidence).alias("significant"))
