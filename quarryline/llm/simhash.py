"""SimHash near-duplicates, found through vantage-point trees over Hamming distance.

Equal fingerprints are one node. A tree of vantage points and radii, grown on a bounded sample of nodes, deals all nodes to
shards: at each vantage point those within the radius go left, the others right. A node whose distance from a vantage point is
near the radius may have neighbours on the other side, which the triangle inequality bounds, so left nodes near the boundary
visit the right shards too; each pair has one side to look from. A shard's own nodes are compared with all that are there, again
through vantage points, and a task gives a spanning forest of its links, not all pairs of a group. Shards that are too
large for a task are compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import hashed_sample, small_side, temporary_tables, written
from quarryline.llm.components import connected_components

RADIUS, SAMPLE, SHARD, BLOCK, DEEPEST, AT_ONCE = 3, 1 << 16, 4096, 16384, 12, 1 << 18
SEED = 42
OWN, RIGHT_OWN, VISITOR, BOTH = range(4)  # a row is the near side of a comparison, the far side (a shard's own or a visitor), or both


def fingerprint(text: str | None, size: int = 3) -> int:
    """64 bits of a text: each is 1 if set in over half the hashes of its shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line, k = b" ".join(words), min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row of docs (doc_id, text), as a signed number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, size) for t in batch.text), np.uint64, len(batch))
            yield pd.DataFrame({"doc_id": pd.array(batch.doc_id, dtype="Int64"), "fp": fps.view(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long")


def distances(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def vantage(points: np.ndarray, candidates: int = 8) -> np.uint64:
    """Of a few of the points, the one whose distances to the others vary most."""
    some, few = points[:: max(1, len(points) // candidates)], points[:: max(1, len(points) // 512)]
    return some[np.argmax(distances(some[:, None], few[None, :]).var(axis=1))]


class Tree:
    """A full binary tree of vantage points and radii; node k of a level has children 2k (within the radius) and 2k + 1."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        parts, self.levels = [np.sort(sample)], []
        for _ in range(depth):
            points, radii, below = [], [], []
            for part in parts:
                v = vantage(part) if len(part) else np.uint64(0)
                d = distances(part, v)
                r = int(np.median(d)) if len(part) else 64
                points.append(v)
                radii.append(r)
                below += [part[d <= r], part[d > r]]
            self.levels.append((np.array(points, np.uint64), np.array(radii, np.int16)))
            parts = below

    def deal(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, shard, own): each point's own shard, and those to its right that may hold points within the radius of it."""
        at, shard, own = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.ones(len(fps), bool)
        for points, radii in self.levels:
            d, r = distances(fps[at], points[shard]), radii[shard]
            left = np.where(own, d <= r, d - radius <= r)
            right = np.where(own, d > r, d + radius > r)
            visit = own & left & (d + radius > r)
            at = np.concatenate([at[left], at[right], at[visit]])
            shard = np.concatenate([shard[left] * 2, shard[right] * 2 + 1, shard[visit] * 2 + 1])
            own = np.concatenate([own[left], own[right], np.zeros(int(visit.sum()), bool)])
        return at, shard, own


class Forest:
    """Links that join components of the points which a task holds; labels tell the components so far."""

    def __init__(self, points: np.ndarray, radius: int) -> None:
        self.points, self.radius, self.labels, self.links = points, radius, np.arange(len(points)), []

    def search(self, near: np.ndarray, far: np.ndarray) -> None:
        """Compare points (by their places) of the near side with those of the far side, through a vantage point while that saves work."""
        work = len(near) * len(far)
        if work > AT_ONCE:
            v = vantage(self.points[near])
            x, y = distances(self.points[near], v), distances(self.points[far], v)
            r = int(np.median(x))
            low, high = near[x <= r], near[x > r]
            reach_low, reach_high = far[y <= r + self.radius], far[y > r - self.radius]
            if len(high) and len(low) * len(reach_low) + len(high) * len(reach_high) < 0.95 * work:
                self.search(low, reach_low)
                self.search(high, reach_high)
                return
        step = max(1, AT_ONCE // max(1, len(far)))
        for k in range(0, len(near), step):
            self._compare(near[k : k + step], far)

    def _compare(self, near: np.ndarray, far: np.ndarray) -> None:
        x, y = np.nonzero(np.bitwise_count(self.points[near][:, None] ^ self.points[far][None, :]) <= self.radius)
        x, y = near[x], far[y]
        while len(apart := np.flatnonzero(self.labels[x] != self.labels[y])):
            x, y = x[apart], y[apart]
            own = y[x == x[0]]
            for b in own[np.unique(self.labels[own], return_index=True)[1]].tolist():
                self.links.append((x[0], b))
                self.labels[self.labels == self.labels[b]] = self.labels[x[0]]

    def found(self) -> pd.DataFrame:
        ends = self.points[np.array(self.links, np.int64).reshape(-1, 2)].view(np.int64)
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})


def linked(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(a, b): links between different fingerprints of nodes (fp) at most radius bits apart, at least a spanning forest of each component.

    The tree is grown on about sample nodes, with shards of about so many nodes, 2^DEEPEST of them at most; each node is dealt.
    """
    count = nodes.count()
    depth = min(DEEPEST, max(0, int(np.ceil(np.log2(max(1, count) / shard)))))
    few = hashed_sample(nodes.select("fp"), ["fp"], sample).toPandas() if depth else pd.DataFrame({"fp": []}, dtype="int64")
    tree = Tree(few.fp.to_numpy().view(np.uint64), depth)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 1024):
                fps = batch.fp.to_numpy()[k : k + 1024]
                at, shards, own = tree.deal(fps.view(np.uint64), radius)
                yield pd.DataFrame({"shard": shards, "fp": fps[at], "own": own})

    dealt = written(nodes.select("fp").mapInPandas(deal, "shard long, fp long, own boolean"), "dealt")
    parts = lambda condition: F.ceil(F.count_if(condition) / block).cast("long")
    sizes = dealt.groupBy("shard").agg(parts(F.col("own")).alias("nears"), parts(F.lit(True)).alias("fars"))
    rows = dealt.join(small_side(written(sizes.where("nears > 0"), "shards")), "shard")
    pick = lambda n: F.pmod(F.xxhash64("fp"), F.col(n))
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    whole = rows.where("fars = 1").select("shard", F.lit(0).alias("near"), F.lit(0).alias("far"), "fp", F.when(F.col("own"), BOTH).otherwise(VISITOR).alias("role"))
    large = rows.where("fars > 1")
    left = large.where("own").select("shard", pick("nears").alias("near"), F.explode(each("fars")).alias("far"), "fp", F.lit(OWN).alias("role"))
    right = large.select("shard", F.explode(each("nears")).alias("near"), pick("fars").alias("far"), "fp", F.when(F.col("own"), RIGHT_OWN).otherwise(VISITOR).alias("role"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        points, places = np.unique(group.fp.to_numpy().view(np.uint64), return_inverse=True)
        role, forest = group.role.to_numpy(), Forest(points, radius)
        near, far = places[(role == OWN) | (role == BOTH)], places[role != OWN]
        if len(near) and len(far):
            forest.search(near, far)
        return forest.found()

    everything = whole.unionByName(left).unionByName(right)
    return everything.groupBy("shard", "near", "far").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = RADIUS, shard: int = SHARD, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for each row of docs (doc_id, text).

    Rows link where their fingerprints differ in at most radius bits; component_id is the smallest doc_id that links reach.
    Texts that are null or without words have fingerprint zero and link like others. Rows without doc_id take part in links, but
    name no component: alone they have a null component_id. Repeated rows get equal rows, texts are read whole, an empty
    table gives an empty one, other columns are left out. The result is a written table; those that lead to it are deleted.
    """
    with temporary_tables(docs.sparkSession):
        own = written(fingerprints(docs, size), "fingerprints")
        nodes = written(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
        groups = written(connected_components(linked(nodes, radius, shard, block, sample), "a", "b"), "groups")
        named = groups.select(F.col("node").alias("fp"), "component").join(nodes, "fp")
        least = named.groupBy("component").agg(F.min("first").alias("component_id"))
        named = written(named.join(least, "component").select("fp", "component_id", F.lit(True).alias("linked")), "named")
        told = nodes.join(small_side(named), "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"))
        out = own.join(told, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
        return written(out, "simhash", keep=True)
