"""Hard negatives by inner product, searched along one-dimensional distance keys.

One more coordinate gives all vectors the same norm, which turns the order by inner product into an order by distance. Every
vector belongs to its nearest pivot, and vectors are stored in pages sorted by (pivot, distance to it). A query at distance d
from a pivot can have neighbours within r only at keys from d - r to d + r, so a search reads the pages of growing key
intervals, nearest first, and ends where the distance left exceeds that of the k-th best found: the result is exact. For
negatives the searched region has an inner side too, as those must stay below a share of the positive's score: an annulus.

Queries come in blocks, taken from neighbouring keys, and a block meets a page as one matrix product. The pivots are fitted on
a bounded sample (SAMPLE rows); every row is indexed and every interval read that may hold a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.common import arrow_rows, hashed_sample, temporary_tables, written

SAMPLE, PIVOTS, PAGE, BLOCK, NEAR = 4096, 32, 4096, 512, 8
LARGEST = 1 << 62  # a squared norm below this keeps scores within eight bytes
NO_ID = np.iinfo(np.int64).max
PAGES = "page long, pivot int, low double, high double, ids binary, labels binary, anchors binary, vectors binary"


def quantised(rows: DataFrame, vector: str, scale: int = 256) -> DataFrame:
    """rows with v: the vector's components times scale, rounded down. Rows with a null, endless or too large component are left out.

    A row is too large if its squared norm reaches LARGEST, as then scores would not fit.
    """
    real = F.transform(vector, lambda x: x.cast("double") * scale)
    kept = rows.where(F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
    kept = kept.where(F.aggregate(real, F.lit(0.0), lambda a, x: a + (F.abs(x) + 1) * (F.abs(x) + 1)) < float(LARGEST))
    return kept.withColumn("v", F.transform(real, lambda x: F.floor(x).cast("long")))


def matrix(cells: pd.Series, dims: int) -> np.ndarray:
    """Vectors as rows of one matrix; shorter ones end in zeros."""
    out = np.zeros((len(cells), dims), np.int64)
    for k, cell in enumerate(cells):
        out[k, : len(cell)] = cell
    return out


class Space:
    """Pivots and the common squared norm of the augmented vectors."""

    def __init__(self, sample: np.ndarray, norm: int, dims: int, pivots: int) -> None:
        self.norm, self.dims = norm, dims
        points = self.augmented(sample)
        centres = points[np.linspace(0, len(points) - 1, min(pivots, len(points))).astype(int)] if len(points) else np.zeros((1, dims + 1))
        for _ in range(6):
            home = self._to(points, centres).argmin(axis=1)
            centres = np.array([points[home == k].mean(axis=0) if (home == k).any() else c for k, c in enumerate(centres)])
        self.centres = centres

    def augmented(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """x as doubles with one more coordinate, that fills up to the common norm; zero for a query."""
        x = x.astype(np.float64)
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, float(self.norm) - (x * x).sum(axis=1)))
        return np.column_stack([x, rest])

    @staticmethod
    def _to(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(centres)))
        for k, c in enumerate(centres):
            out[:, k] = np.sqrt(((x - c) ** 2).sum(axis=1))
        return out

    def keys(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Distances to all pivots."""
        return self._to(self.augmented(x, query), self.centres)

    def radius(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """How far from queries q a vector of this score lies; scores of -inf lie endlessly far."""
        own = (q.astype(np.float64) ** 2).sum(axis=1)
        return np.sqrt(np.maximum(0.0, own + float(self.norm) - 2 * score))

    def slack(self) -> float:
        """More than rounding can change in a distance."""
        return 1e-6 * (1 + float(self.norm) ** 0.5)

    def scores(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact inner products: doubles hold them while norms stay below 2^53."""
        if self.norm < 1 << 53:
            return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        return q.astype(np.int64) @ x.astype(np.int64).T


def stored(rows: DataFrame, space: Space, page: int) -> DataFrame:
    """rows (vec_id, label, anchor, v) as pages sorted by (pivot, distance); a page's number is that of its first row."""
    dims, kind = space.dims, "vec_id long, label long, anchor boolean, v array<long>, pivot int, key double"

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            to = space.keys(matrix(batch.v, dims))
            pivot = to.argmin(axis=1) if len(batch) else np.zeros(0, np.int64)
            ids = pd.array(batch.vec_id, dtype="Int64")
            yield batch.assign(vec_id=ids, pivot=pivot.astype(np.int32), key=to[np.arange(len(batch)), pivot])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, held = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) and (len(held) > page or held["pivot"].iloc[0] != held["pivot"].iloc[-1]):
                n = min(page, int((held["pivot"] != held["pivot"].iloc[0]).to_numpy().argmax()) or page)
                yield one(first, held.iloc[:n])
                first, held = first + n, held.iloc[n:].reset_index(drop=True)
        if held is not None and len(held):
            yield one(first, held)

    def one(first: int, part: pd.DataFrame) -> pd.DataFrame:
        ids = pd.array(part.vec_id, dtype="Int64").fillna(NO_ID).to_numpy(np.int64)
        data = (ids, part.label.to_numpy(np.int64), part.anchor.to_numpy(bool), matrix(part.v, dims).astype(np.int32))
        return pd.DataFrame([(first, part["pivot"].iloc[0], part.key.min(), part.key.max(), *(x.tobytes() for x in data))], columns=["page", "pivot", "low", "high", "ids", "labels", "anchors", "vectors"])

    order = ["pivot", "key", "vec_id"]
    keyed = rows.select("vec_id", "label", "anchor", "v").mapInPandas(key, kind)
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pack, PAGES)


def in_blocks(pages: DataFrame, space: Space, block: int) -> DataFrame:
    """The anchors of pages, in blocks in the pages' order: (block, rows, ids, labels, vectors, nearest, farthest); the last are lists by pivot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            for page in batch.itertuples():
                at = np.flatnonzero(np.frombuffer(page.anchors, bool))
                if len(at):
                    held.append((at + page.page, np.frombuffer(page.ids, np.int64)[at], np.frombuffer(page.labels, np.int64)[at], np.frombuffer(page.vectors, np.int32).reshape(-1, space.dims)[at]))
                    n += len(at)
                if n >= block:
                    yield from out(held)
                    held, n = [], 0
        yield from out(held)

    def out(held: list[tuple]) -> Iterator[pd.DataFrame]:
        if held:
            parts = [np.concatenate(x) for x in zip(*held, strict=True)]
            for k in range(0, len(parts[0]), block):
                own = [x[k : k + block] for x in parts]
                to = space.keys(own[3], query=True)
                row = (int(own[0][0]), *(x.tobytes() for x in own), to.min(axis=0), to.max(axis=0))
                yield pd.DataFrame([row], columns=["block", "rows", "ids", "labels", "vectors", "nearest", "farthest"])

    kinds = "block long, rows binary, ids binary, labels binary, vectors binary, nearest array<double>, farthest array<double>"
    return pages.select("page", "ids", "labels", "anchors", "vectors").mapInPandas(run, kinds)


def rings(blocks: DataFrame, pages: DataFrame, near: int) -> DataFrame:
    """(block, page, pivot, low, high, least, ring): for each block all pages by key intervals; ring k holds about near * 4^k, nearest first.

    least is a lower bound of the distance from any of the block's anchors to any row of the page.
    """
    spans = blocks.select("block", F.posexplode(F.arrays_zip("nearest", "farthest")).alias("pivot", "d"))
    both = spans.join(pages.select("page", "pivot", "low", "high"), "pivot")
    least = F.greatest(F.lit(0.0), F.col("d.nearest") - F.col("high"), F.col("low") - F.col("d.farthest"))
    both = both.select("block", "page", "pivot", "low", "high", least.alias("least"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("least", "page"))
    return both.withColumn("ring", F.floor(F.log(4.0, 1 + 3 * (place - 1) / near)).cast("int"))


def best_of(scores: np.ndarray, ids: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best valid ones, higher scores first, ties by smaller id and place."""
    at = np.flatnonzero(valid)
    if len(at) > k:
        own = scores[at]
        at = at[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return at[np.lexsort((at, ids[at], -scores[at]))][:k]


def searched(wanted: DataFrame, blocks: DataFrame, pages: DataFrame, state: DataFrame, space: Space, k: int, pick: Callable, radius: Callable) -> DataFrame:
    """(block, at, goal, row, vec_id, score, place): for each anchor (block and place there) and goal the k best rows, from place 1 on.

    state: (block, at, goal, bound), one row a search, at first without bound. Ring after ring the pages are read that may
    still hold a better row; radius tells, from scores, queries and goals, the inner and outer distances that count, pick the
    valid rows.
    """
    slack = space.slack()
    kinds = "block long, at int, goal long, row long, vec_id long, score long"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x in batch.itertuples():
                ids, labels = np.frombuffer(x.ids, np.int64), np.frombuffer(x.labels, np.int64)
                vectors = np.frombuffer(x.vectors, np.int32).reshape(-1, space.dims)
                own, own_labels = np.frombuffer(x.q_rows, np.int64), np.frombuffer(x.q_labels, np.int64)
                queries = np.frombuffer(x.q_vectors, np.int32).reshape(-1, space.dims)
                at, goal = np.array([g["at"] for g in x.goals]), np.array([g["goal"] for g in x.goals])
                bound = np.array([float("-inf") if g["bound"] is None else g["bound"] for g in x.goals], np.float64)
                to = np.sqrt(((space.augmented(queries, query=True) - space.centres[x.pivot]) ** 2).sum(axis=1))[at]
                inner, outer = radius(queries[at], goal, bound)
                live = np.flatnonzero((np.maximum(to - x.high, x.low - to) <= outer + slack) & (to + x.high >= inner - slack))
                if not len(live):
                    continue
                used, where = np.unique(at[live], return_inverse=True)
                scores, found = space.scores(queries[used], vectors), []
                for j, w in zip(live.tolist(), where.tolist(), strict=True):
                    s = scores[w]
                    valid = pick(s, goal[j], labels == own_labels[at[j]]) & (s >= bound[j])
                    if 0 <= (self_at := own[at[j]] - x.page) < len(ids):
                        valid[self_at] = False
                    top = best_of(s, ids, valid, k)
                    found.append((np.full(len(top), at[j]), np.full(len(top), goal[j]), top + x.page, ids[top], s[top]))
                cols = [np.concatenate(c) for c in zip(*found, strict=True)]
                yield pd.DataFrame({"block": x.block, "at": cols[0].astype(np.int32), "goal": cols[1], "row": cols[2], "vec_id": cols[3], "score": cols[4]})

    spark, best = wanted.sparkSession, None
    order = Window.partitionBy("block", "at", "goal").orderBy(F.desc("score"), "vec_id", "row")
    data = blocks.select("block", *(F.col(c).alias(f"q_{c}") for c in ("rows", "labels", "vectors")))
    for ring in range((wanted.agg(F.max("ring")).first()[0] or 0) + 1):
        bounds = state if best is None else state.drop("bound").join(best.groupBy("block", "at", "goal").agg(F.when(F.count("*") == k, F.min("score")).alias("bound")), ["block", "at", "goal"], "left")
        goals = bounds.groupBy("block").agg(F.collect_list(F.struct("at", "goal", "bound")).alias("goals"))  # of one block of anchors
        pairs = wanted.where(F.col("ring") == ring).join(data.join(goals, "block"), "block")
        rows = pairs.join(pages.drop("pivot", "low", "high", "anchors"), "page")
        with arrow_rows(spark, 4):
            found = written(rows.mapInPandas(scan, kinds), "found")
        every = found if best is None else best.drop("place").unionByName(found)
        best = written(every.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "best")
    return best


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, page: int = PAGE, block: int = BLOCK, near: int = NEAR, pivots: int = PIVOTS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, for the rows where anchor holds.

    rows: vec_id, label and v (whole numbers, see quantised). An anchor's positives are the best other rows of its label; for
    each the best rows of other labels whose score lies between low and high percent of the positive's are its negatives.
    Ties go by vec_id, then by place in the index. Rows without label or vector take no part; rows without vec_id come last among
    ties. Repeated rows are rows of their own, of different length vectors the shorter ones end in zeros, an empty table
    gives an empty one, other columns are left out. The result is a written table; those that lead to it are deleted.
    """
    spark = rows.sparkSession
    own = rows.where("label is not null and v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), "v")
    with temporary_tables(spark):
        squares = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
        norm, dims = own.agg(F.coalesce(F.max(squares), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        dims = max(1, dims)
        sample = hashed_sample(own.select("vec_id", "v"), ["vec_id"], SAMPLE).orderBy("vec_id").toPandas()  # bounded
        space = Space(matrix(sample.v, dims), norm, dims, pivots)
        with arrow_rows(spark, 2048):
            pages = written(stored(own, space, page), "pages")
        with arrow_rows(spark, 16):
            blocks = written(in_blocks(pages, space, block), "blocks")
        wanted = written(rings(blocks, pages, near), "wanted")

        every = blocks.select("block", F.explode(F.sequence(F.lit(0), (F.length("rows") / 8).cast("int") - 1)).alias("at"))
        state = every.select("block", "at", F.lit(0).cast("long").alias("goal"), F.lit(None).cast("long").alias("bound"))
        outside = lambda q, goal, bound: (np.zeros(len(q)), space.radius(q, bound))
        same = lambda s, goal, equal: equal.copy()
        best = searched(wanted, blocks, pages, state, space, positives, same, outside)

        # a negative score has no room between its low and high percent
        state = written(best.where("score >= 0").select("block", "at", F.col("score").alias("goal")).distinct().withColumn("bound", F.lit(None).cast("long")), "goals")
        annulus = lambda q, goal, bound: (space.radius(q, goal * high / 100), space.radius(q, np.maximum(bound, goal * low / 100)))
        hard = lambda s, goal, equal: ~equal & (100 * s >= low * goal) & (100 * s <= high * goal)
        found = searched(wanted, blocks, pages, state, space, negatives, hard, annulus)

        def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for x in batch.itertuples():
                    ids = np.frombuffer(x.ids, np.int64)
                    yield pd.DataFrame({"block": x.block, "at": np.arange(len(ids), dtype=np.int32), "anchor_id": ids})

        names = blocks.select("block", "ids").mapInPandas(named, "block long, at int, anchor_id long")
        known = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
        pairs = best.select("block", "at", F.col("score").alias("goal"), F.col("vec_id").alias("positive"))
        out = found.join(pairs, ["block", "at", "goal"]).join(names, ["block", "at"])
        out = out.select(known("anchor_id").alias("anchor_id"), known("positive").alias("positive_id"), F.col("place").cast("int").alias("rank"), known("vec_id").alias("negative_id"), F.col("goal").alias("positive_score"), F.col("score").alias("negative_score"))
        return written(out, "negatives", keep=True)
