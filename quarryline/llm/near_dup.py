"""MinHash near-duplicates with sequential Bayesian verification and exact confirmation.

Documents become sets of word shingles; equal sets are one node from the start, so copies cost one row. Nodes that agree
on a band of their signatures are candidates. A bucket's candidates are first compared with the one of them that meets most
others; the links found give components, and then only nodes of one bucket that are still in different components are
compared with each other, in large buckets block by block. Links inside a component cannot change it, so no link that
counts is lost and no bucket is expanded into all pairs.

A comparison reads both signatures batch by batch and ends when the posterior probability (uniform prior) that the
similarity reaches the threshold falls below MISS. What survives is confirmed on the full sets. Sets are held as 64-bit hashes
of shingles. A node is a 64-bit hash of a set; where two sets share it, which a second hash of 64 bits shows, they are nodes
of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import arrow_rows, small_side, temporary_tables, written
from quarryline.llm.components import connected_components

ROWS, BANDS, MISS, LARGE, CACHE = 6, 36, 1e-7, 32, 400_000
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = WordHashes()


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of size words; of the whole sequence if it has fewer; none without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > CACHE:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        out = (out ^ h[j : len(h) - k + 1 + j]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signature(own: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The least value of the set under each hash function."""
    x = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(by), np.uint32(0xFFFFFFFF))
    for k in range(0, len(x), 2048):
        np.minimum(least, np.multiply.outer(by, x[k : k + 2048]).min(axis=1), out=least)
    return least


def least_matches(total: int, threshold: float, miss: float, batch: int) -> list[int]:
    """For each batch read, the matches below which the similarity reaches the threshold with probability under miss."""
    out = []
    for n in range(batch, total + 1, batch):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append(m)
    return out


def sketch(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS, whole: bool = False) -> DataFrame:
    """doc_id, n_shingles, node and proof (hashes of the set; null if empty), data (the signature, or the set itself if whole) and keys.

    keys holds a hash of each band with its number; none if whole.
    """
    by, hash_of = multipliers(bands * rows), set_hash

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 1000):
                part, nodes, proofs, data, sizes = batch.iloc[k : k + 1000], [], [], [], []
                for text in part.text:
                    own = shingles(text, size)
                    sizes.append(len(own))
                    raw = own.tobytes()
                    node, proof = divmod(hash_of(raw), 1 << 64)
                    nodes.append(node - (node >> 63 << 64) if len(own) else None)
                    proofs.append(proof - (proof >> 63 << 64) if len(own) else None)
                    data.append((raw if whole else signature(own, by).tobytes()) if len(own) else None)
                ids = pd.array(part.doc_id, dtype="Int64")
                keys = [None if whole or d is None else band_keys(np.frombuffer(d, np.uint32).reshape(bands, rows)) for d in data]
                yield pd.DataFrame({"doc_id": ids, "n_shingles": sizes, "node": pd.array(nodes, dtype="Int64"), "proof": pd.array(proofs, dtype="Int64"), "data": data, "keys": keys})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_shingles long, node long, proof long, data binary, keys array<long>")


def set_hash(raw: bytes) -> int:
    """128 bits of a set's bytes."""
    return xxhash.xxh3_128_intdigest(raw)


def told_apart(sketched: DataFrame) -> tuple[DataFrame, bool]:
    """sketched with nodes of their own for sets that share a node but not its proof, and whether there are any."""
    shared = sketched.where("node is not null").groupBy("node").agg(F.min("proof").alias("x"), F.max("proof").alias("y"))
    shared = written(shared.where("x <> y").select("node", F.lit(True).alias("shared")), "shared")
    if not shared.take(1):
        return sketched, False
    out = sketched.join(small_side(shared), "node", "left")
    own = F.when(F.col("shared"), F.xxhash64("node", "proof")).otherwise(F.col("node"))
    return written(out.withColumn("node", own).select(sketched.columns), "sketch"), True


def band_keys(parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band (row) of a signature and the band's number."""
    out = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for column in parts.T:
        out = (out ^ column) * MIX
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def likely(pairs: DataFrame, sets: DataFrame, percent: int, bands: int, rows: int, miss: float) -> DataFrame:
    """The pairs (a, b) that sizes and signatures leave."""
    total, batch = bands * rows, 36 if (bands * rows) % 36 == 0 else rows
    need = least_matches(total, percent / 100, miss, batch)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            left, right = (np.frombuffer(b"".join(part[c]), np.uint32).reshape(-1, total) for c in ("sig_a", "sig_b"))
            alive, matches = np.arange(len(part)), np.zeros(len(part), np.int64)
            for k, least in enumerate(need):
                cut = slice(k * batch, (k + 1) * batch)
                matches[alive] += (left[alive, cut] == right[alive, cut]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield part.iloc[alive][["a", "b"]]

    side = lambda x: sets.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("data").alias(f"sig_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return both.select("a", "b", "sig_a", "sig_b").mapInPandas(run, "a long, b long")


def full_sets(nodes: DataFrame, docs: DataFrame, size: int, clashing: bool = False) -> DataFrame:
    """(node, data): the whole shingle sets of some nodes (node, doc_id), from their documents' texts; without doc_id, from all such rows'.

    clashing: some sets share a hash and have nodes of their own.
    """
    ids = written(nodes.select("doc_id").distinct(), "ids")
    texts = docs.select("doc_id", "text").join(small_side(ids), "doc_id", "left_semi")
    if ids.where("doc_id is null").take(1):  # a join matches no null
        texts = texts.unionByName(docs.select("doc_id", "text").where("doc_id is null"))
    sets = sketch(texts, size, whole=True).where("node is not null")
    if clashing:
        sets = sets.unionByName(sets.withColumn("node", F.xxhash64("node", "proof")))
    return sets.join(small_side(nodes.select("node")), "node", "left_semi").groupBy("node").agg(F.min("data").alias("data"))


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            good = []
            for x, y in zip(part.set_a, part.set_b, strict=True):
                left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                good.append(100 * common >= percent * (len(left) + len(right) - common))
            yield part.loc[good, ["a", "b"]]

    side = lambda x: full.select(F.col("node").alias(x), F.col("data").alias(f"set_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInPandas(run, "a long, b long")


def across(rest: DataFrame, met: DataFrame, full: DataFrame, percent: int, bands: int, rows: int, miss: float) -> DataFrame:
    """Links (a, b) between different components of large buckets, without a row for each pair.

    A bucket's nodes are laid in cells by the logarithm of their set's size, so that similar ones are at most one cell apart. The
    nodes outside the bucket's largest component, in blocks of about 64, meet the nodes of these cells, in blocks of about
    512: as many rows as nodes times blocks, and each pair of blocks is a task of bounded size. A pair is compared in the
    first band that it shares, and its exact check happens there too, unless links of this block already join the two.
    """
    total, batch = bands * rows, 36 if (bands * rows) % 36 == 0 else rows
    need = np.array(least_matches(total, percent / 100, miss, batch))
    counts = rest.groupBy("key", "component").agg(F.count("*").alias("c"))
    main = counts.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top")).select("key", F.col("top.component").alias("main"))
    cell = F.floor(F.ln("n") / (max(log(100 / percent), 1e-6) * (1 + 1e-9))).cast("int")
    nodes = rest.join(main, "key").select("key", cell.alias("cell"), "node", "component", (F.col("component") != F.col("main")).alias("minor"))
    nodes = written(nodes, "apart")
    few = nodes.where("minor").withColumn("cell", F.explode(F.array(*(F.col("cell") + k for k in (-1, 0, 1)))))
    sizes = few.groupBy("key", "cell").agg(F.ceil(F.count("*") / 64).alias("few"))
    sizes = sizes.join(nodes.groupBy("key", "cell").agg(F.ceil(F.count("*") / 512).alias("all")), ["key", "cell"])
    pick = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "cell", "few_block", "all_block", "node", "component", "minor"]
    left = few.join(sizes, ["key", "cell"]).withColumn("few_block", pick("few")).withColumn("all_block", spread("all")).select(columns)
    right = nodes.join(sizes, ["key", "cell"]).withColumn("all_block", pick("all")).withColumn("few_block", spread("few")).select(columns)
    sketches = met.select("node", F.col("data").alias("sig")).join(full.select("node", F.col("data").alias("set")), "node")
    left, right = (x.join(sketches, "node").select(*columns, "sig", "set").toDF(*columns, "sig", "set").groupBy(columns[:4]) for x in (left, right))

    def run(key: tuple, few: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        out, root = [], {}

        def joined(c: int) -> int:
            while (up := root.get(c, c)) != c:
                c = up
            return c

        if len(few) and len(many):
            sig = np.frombuffer(b"".join(many.sig), np.uint32).reshape(-1, total)
            sets = [np.frombuffer(x, np.uint64) for x in many.set]
            sizes, nodes, components = np.array([len(x) for x in sets]), many.node.to_numpy(), many.component.to_numpy()
            for node, component, own, data in zip(few.node, few.component, few.sig, few.set, strict=True):
                mine, own_set = np.frombuffer(own, np.uint32), np.frombuffer(data, np.uint64)
                n, here = len(own_set), np.flatnonzero(band_keys(mine.reshape(bands, rows)) == key[0])[0]
                ok = (components != component) & (np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * percent)
                at = np.flatnonzero(ok & (~many.minor.to_numpy(bool) | (nodes > node)))
                same = sig[at] == mine
                ok = ~same[:, : here * rows].reshape(len(at), here, rows).all(axis=2).any(axis=1)
                ok &= (same.reshape(len(at), total // batch, batch).sum(axis=2).cumsum(axis=1) >= need).all(axis=1)
                for k in at[ok].tolist():
                    x, y = joined(component), joined(int(components[k]))
                    if x == y:
                        continue
                    common = len(np.intersect1d(own_set, sets[k], assume_unique=True))
                    if 100 * common >= percent * (n + sizes[k] - common):
                        out.append((node, nodes[k]))
                        root[y] = x
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return left.cogroup(right).applyInPandas(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, miss: float = MISS, large: int = LARGE
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs (doc_id, text).

    component_id is the smallest doc_id that links reach, kept tells whether it is the row's own. Texts without words are
    linked with nothing. Rows without doc_id take part in links, but name no component: one alone has a null component_id
    and is kept. Repeated rows get equal rows. Other columns are left out. The result is a written table; those that lead to
    it are deleted.
    """
    with temporary_tables(docs.sparkSession):
        return written(_grouped(docs, size, percent, bands, rows, miss, large), "near_duplicates", keep=True)


def _grouped(docs: DataFrame, size: int, percent: int, bands: int, rows: int, miss: float, large: int) -> DataFrame:
    sketched, clashing = told_apart(written(sketch(docs, size, bands, rows), "sketch"))
    held = sketched.where("node is not null")
    sets = held.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("data").alias("data"), F.first("keys").alias("keys"))
    sets = written(sets, "nodes")

    banded = sets.select("node", F.explode("keys").alias("key"))
    buckets = written(banded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
    members = written(banded.join(small_side(buckets), "key"), "members")
    # a node that shares its bands with many others stands in the middle of its group: the first to meet them
    known = members.groupBy("node").agg(F.sum("m").alias("popular"))
    members = members.join(known, "node")
    leads = members.groupBy("key").agg(F.max(F.struct("popular", "node")).alias("top")).select("key", F.col("top.node").alias("lead"))
    members = written(members.join(leads, "key"), "members")
    met = written(members.select("node").distinct(), "met")
    met = written(sets.join(small_side(met), "node", "left_semi"), "met")
    confirmable: dict = {}

    def apart(members: DataFrame, found: DataFrame) -> DataFrame:
        """The members of buckets whose nodes are not all in one component, with their components."""
        groups = connected_components(found, "a", "b")
        sized = members.join(met.select("node", F.col("n_shingles").alias("n")), "node").join(groups, "node", "left")
        sized = sized.select("key", "node", "lead", "m", "n", "popular", F.coalesce("component", "node").alias("component"))
        mixed = sized.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
        return written(sized.join(mixed, "key", "left_semi"), "rest")

    def links(pairs: DataFrame) -> DataFrame:
        """The pairs that prove similar. Sets may be large, so they come to Python a few at a time."""
        survivors = written(likely(pairs, met, percent, bands, rows, miss), "survivors")
        with arrow_rows(docs.sparkSession, 64):
            if "full" not in confirmable:
                confirmable["full"] = written(full_sets(met.select("node", "doc_id"), docs, size, clashing), "full")
            return written(confirmed(survivors, confirmable["full"], percent), "links")

    found = links(members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())
    rest = apart(members, found)
    x, y = (rest.where(F.col("m") <= large).alias(k) for k in "xy")
    fits = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component")) & fits)
    second = links(cross.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    third = written(across(rest.where(F.col("m") > large), met, confirmable["full"], percent, bands, rows, miss), "links")

    groups = connected_components(found.unionByName(second).unionByName(third), "a", "b")
    named = sets.select("node", "doc_id").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.select("node", "component").join(names, "component").select("node", "component_id")
    out = held.select("doc_id", "n_shingles", "node").join(named, "node", "left").select("doc_id", "n_shingles", "component_id")
    empty = sketched.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with their columns, of which one of each near-duplicate group stays: that of the smallest doc_id.

    Where doc_id is missing or repeated, rows are numbered first, and the row of the smallest number stays.
    """
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").take(1)
    key = "doc_id"
    rows = docs
    if unclear:
        while key in docs.columns:
            key += "_"
        rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), size, percent)
    gone = written(found.where("not kept").select(F.col("doc_id").alias(key)), "gone")
    return rows.join(small_side(gone), key, "left_anti").select(*docs.columns)
