"""Ranks among the neighbours of vectors: block by block, no pair of vectors is listed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.session import stored

# Asked vectors and rows that meet in one group, rows at a time, and how near to a bound products are summed anew.
ASKED, ROWS, SLICE, NEAR = 4096, 8192, 1024, 1e-8


def matrix(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(vectors as rows, which of them are whole); vectors of another width, without value or with null or NaN components have no score."""
    wide = max((len(v) for v in vectors if v is not None), default=0)
    whole = np.array([v is not None and len(v) == wide for v in vectors], bool)
    out = np.zeros((len(vectors), wide))
    if whole.any():
        out[whole] = np.stack([np.asarray(v, np.float64) for v in vectors[whole]])
        whole &= ~np.isnan(out).any(axis=1)
        out[~whole] = 0
    return out, whole


def summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, pair by pair, summed in order of the components whatever the block."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


class Block:
    """Scores of some asked vectors with rows: product by the row's norm, in nine digits; unknown ones stand behind all others."""

    def __init__(self, asked: pd.DataFrame, rows: pd.DataFrame) -> None:
        (self.asked, known), (self.rows, whole) = matrix(asked.vec), matrix(rows.vec)
        width = max(self.asked.shape[1], self.rows.shape[1])  # a side without vectors has none
        self.asked, self.rows = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (self.asked, self.rows))
        self.norms = np.sqrt(summed(self.rows, self.rows))
        self.unknown = ~known[:, None] | ~whole | (self.norms == 0)
        self.keys, self.own = rows.key.to_numpy(), asked.key.to_numpy()
        self.rough = self.asked @ (self.rows / np.where(self.norms == 0, 1, self.norms)[:, None]).T
        self.rough[self.unknown] = -np.inf

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Scores of pairs."""
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.round(summed(self.asked[i], self.rows[j]) / self.norms[j], 9)
        return np.where(self.unknown[i, j], -np.inf, score)


def slices(rows: pd.DataFrame) -> list[pd.DataFrame]:
    return [rows.iloc[k : k + SLICE] for k in range(0, len(rows), SLICE)]


def best_of_label(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """(key, score, first): each asked vector's best row of its label in a group."""
    found = []
    for part in slices(rows):
        block = Block(asked, part)
        same = (asked.label.to_numpy()[:, None] == part.label.to_numpy()) & asked.label.notna().to_numpy()[:, None] & (block.own[:, None] != block.keys)
        rough = np.where(same, block.rough, -np.inf)
        i, j = np.nonzero(same & (rough >= rough.max(axis=1, initial=-np.inf)[:, None] - NEAR))
        found.append(pd.DataFrame({"key": block.own[i], "score": block.exact(i, j), "first": block.keys[j]}))
    out = pd.concat(found) if found else pd.DataFrame({"key": [], "score": [], "first": []})
    return out.sort_values(["key", "score", "first"], ascending=[True, False, True]).drop_duplicates("key")


def before_best(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """(key, n): how many rows of a group stand before each asked vector's best row of its label."""
    n, score, first = np.zeros(len(asked), np.int64), asked.score.to_numpy(np.float64), asked["first"].to_numpy()
    for part in slices(rows):
        block = Block(asked, part)
        other = block.own[:, None] != block.keys
        n += (other & (block.rough > score[:, None] + NEAR)).sum(axis=1)
        near = (block.rough >= score[:, None] - NEAR) & ~(block.rough > score[:, None] + NEAR)
        i, j = np.nonzero(other & near)
        own = block.exact(i, j)
        np.add.at(n, i, (own > score[i]) | (own == score[i]) & (block.keys[j] < first[i]))
    return pd.DataFrame({"key": asked.key, "n": n})


def label_ranks(vectors: DataFrame, key: str, vector: str, label: str, asked: Column) -> DataFrame:
    """(key, rank) of each asked row: the place, among all other rows by cosine and then key, of the first row of its label; null without one.

    Blocks of asked rows meet blocks of all rows twice: the best row of the label is found, then what stands before it is counted.
    Products of whole blocks only bound the scores; those near a bound are summed again in one fixed order. A group holds a block
    of each side, whatever the size of the table. Keys are whole numbers and unique.
    """
    rows = stored(vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vec"), F.col(label).cast("string").alias("label"), asked.alias("asked")), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).first()
    parts, blocks = size.n // ROWS + 1, size.q // ASKED + 1
    of = lambda n: F.pmod(F.xxhash64("key"), F.lit(n))
    spread = lambda df, own, n, other, m: df.select("*", of(n).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other))
    right = spread(rows.drop("asked"), "part", parts, "block", blocks).groupBy("block", "part")
    meet = lambda df, run, schema: spread(df, "block", blocks, "part", parts).groupBy("block", "part").cogroup(right).applyInPandas(run, schema)
    queries = rows.where("asked").select(*(F.col(c).alias(c) for c in ("key", "vec", "label")))
    best = meet(queries, best_of_label, "key long, score double, first long").groupBy("key").agg(F.max(F.struct("score", (-F.col("first")).alias("low"))).alias("x"))
    best = stored(best.select("key", "x.score", (-F.col("x.low")).alias("first")), "best")
    n = meet(queries.join(best, "key"), before_best, "key long, n long").groupBy("key").agg((F.sum("n") + 1).alias("rank"))
    return queries.select("key").join(n, "key", "left")
