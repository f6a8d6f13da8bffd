"""Alignment of two tokenizers by elementary intervals, and counts of linked token ids over a corpus.

Both tokenizers cut the same bytes. The union of their token ends cuts a text into elementary intervals; each interval lies in
one token of either side, found by binary search, and is one overlap of the two. Ends that both share close groups.

A link's count is the number of documents that hold its pair of ids linked. Documents are read in blocks of bounded size: a
block lists its different pairs once with their documents, its documents point into that list. Sums over blocks are one plain
aggregation, their answers one join in which a pair has a row a block at most, so that no id is hot however common it is.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import arrow_rows, small_side, temporary_tables, written
from quarryline.llm.packing import byte_chars

BLOCK, CHUNK, AT_ONCE, CACHE = 16 << 20, 8192, 1 << 20, 500_000
NONE = np.zeros(0, np.int64)


class Alignment(NamedTuple):
    """Token ids and byte ends of both sides, the ends that both share, and of each elementary interval the tokens' places."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    shared: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    def pairs(self) -> np.ndarray:
        """For each link the two ids in one number, the first side's above."""
        return self.ids_a[self.link_a] << 32 | self.ids_b[self.link_b]


EMPTY = Alignment(*[NONE] * 7)


def aligned(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Both cuts of one text laid over each other. Tokens have a byte at least and both sides end at the same byte."""
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # union1d of arrays in order: two runs are merged
    ends = ends[np.append(ends[1:] != ends[:-1], len(ends) > 0)]
    link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    shared = ends[(ends_a[link_a] == ends) & (ends_b[link_b] == ends)]
    return Alignment(ids_a, ids_b, ends_a, ends_b, shared, link_a, link_b)


class Tokenizers:
    """A byte-level vocabulary (A, for tokenizers) and a piece vocabulary (B, for sentencepiece) with the bytes of their tokens."""

    # The words that A's byte-level splitting makes, where Unicode tables cannot differ: ASCII without odd controls, and Latin letters.
    PLAIN, WORD = re.compile("[\t\n\r -~\u00c0-\u024f]*"), regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    _of: dict[tuple, Tokenizers] = {}

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        split = json.loads(self.a.to_str())
        self.by_words = split["normalizer"] is None and split["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.cache: dict[str, bytes | None] = {}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        chars = byte_chars()
        names = self.a.get_vocab()
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            self.bytes_a[k] = bytes(chars[c] for c in name) if all(c in chars for c in name) else name.encode()
        piece = lambda k: bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace("▁", " ").encode()
        self.bytes_b = [piece(k) for k in range(self.b.vocab_size())]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        ids = lambda n, mark: [b"%d%c" % (k, mark) for k in range(n)]
        self.words = np.array([*ids(len(self.bytes_a), b","), *ids(len(self.bytes_a), b"|"), *ids(len(self.bytes_b), b","), *ids(len(self.bytes_b), b";")], object)

    @classmethod
    def of(cls, *paths: str) -> Tokenizers:
        if paths not in cls._of:
            cls._of[paths] = cls(*paths)
        return cls._of[paths]

    def align(self, texts: list[str | None]) -> Iterator[Alignment]:
        """The alignment of each text behind a space; an empty one where there is no text or the tokens' bytes are not the text's."""
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to] or "") <= AT_ONCE):
                size += len(texts[to] or "")
                to += 1
            part = texts[at:to]
            right = self.b.encode([t or "" for t in part], num_threads=1)
            for text, a, b in zip(part, self.ids_a(part), right, strict=True):
                yield self._one(text, a, b)
            at = to

    def ids_a(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """A's ids of each text behind a space; None where there is no text or the tokens' bytes are not its own.

        Plain texts are put together from their words, which are encoded once while the cache holds them; others, and those with
        words of over 64 characters, go to the tokenizer as a whole.
        """
        words = [self.WORD.findall(" " + t) if t and self.by_words and self.PLAIN.fullmatch(t) else None for t in texts]
        words = [w if w and max(map(len, w)) <= 64 else None for w in words]
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = list(set().union(*(w for w in words if w)) - self.cache.keys())
        for word, x in zip(new, self.a.encode_batch_fast(new, add_special_tokens=False), strict=True):
            whole = b"".join(map(self.bytes_a.__getitem__, x.ids)) == word.encode()
            self.cache[word] = np.array(x.ids, np.int64).tobytes() if whole else None
        rest = iter(self.a.encode_batch_fast([" " + t for t, w in zip(texts, words, strict=True) if t and not w], add_special_tokens=False))
        out: list[np.ndarray | None] = []
        for text, w in zip(texts, words, strict=True):
            if w:
                parts = list(map(self.cache.__getitem__, w))
                out.append(None if None in parts else np.frombuffer(b"".join(parts), np.int64))
            elif text:
                ids = next(rest).ids
                out.append(np.array(ids, np.int64) if b"".join(map(self.bytes_a.__getitem__, ids)) == b" " + text.encode() else None)
            else:
                out.append(None)
        return out

    def _one(self, text: str | None, ids_a: np.ndarray | None, b: list[int]) -> Alignment:
        if ids_a is None or b"".join(map(self.bytes_b.__getitem__, b)) != b" " + text.encode():
            return EMPTY
        ids_b = np.array(b, np.int64)
        return aligned(ids_a, ids_b, self.sizes_a[ids_a].cumsum(), self.sizes_b[ids_b].cumsum())

    def groups_text(self, x: Alignment) -> bytes:
        """The groups as text, ids in order: ``a1,a2|b1;a3|b2,b3``."""
        if not len(x.shared):
            return b""
        group_a, group_b = np.searchsorted(x.shared, x.ends_a), np.searchsorted(x.shared, x.ends_b)
        place_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")
        last = lambda group: np.append(group[1:] != group[:-1], True)
        n_a, n_b, out = len(self.bytes_a), len(self.bytes_b), np.empty(len(group_a) + len(group_b), np.int64)
        out[place_a] = x.ids_a + n_a * last(group_a)
        out[place_b] = 2 * n_a + x.ids_b + n_b * last(group_b)
        return b"".join(self.words[out].tolist())[:-1]


def aligned_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, group_no, start, end, a_ids, b_ids): each group of docs (doc_id, text) with its byte span in space + text.

    Texts that are null or empty, or that a side cannot give back, have no group. Rows without doc_id and repeated rows are
    read like others; other columns are left out. No shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = Tokenizers.of(path_a, path_b)
        for batch in batches:
            for doc, x in zip(batch.doc_id, both.align(batch.text.tolist()), strict=True):
                a, b = (np.split(ids, np.searchsorted(ends, x.shared, "right")[:-1]) for ids, ends in ((x.ids_a, x.ends_a), (x.ids_b, x.ends_b)))
                n = len(x.shared)
                if n:
                    starts = np.append(0, x.shared[:-1])
                    yield pd.DataFrame({"doc_id": pd.array([doc] * n, dtype="Int64"), "group_no": np.arange(n), "start": starts, "end": x.shared, "a_ids": a, "b_ids": b})

    rows = docs.select("doc_id", "text")
    return rows.mapInPandas(run, "doc_id long, group_no long, start long, end long, a_ids array<int>, b_ids array<int>")


def group_products(groups: DataFrame) -> DataFrame:
    """groups (see aligned_groups) with a row for each pair of an A and a B place inside a group: all that a group may align."""
    rows = groups.select("doc_id", "group_no", F.posexplode("a_ids").alias("a_place", "a_id"), "b_ids")
    return rows.select("doc_id", "group_no", "a_place", "a_id", F.posexplode("b_ids").alias("b_place", "b_id"))


def _blocks(docs: DataFrame, path_a: str, path_b: str, size: int) -> DataFrame:
    """Rows of two kinds: a document with its figures and its different pairs (places in its block's list, times), or a piece of that list."""
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "first", "pairs", "holders"]

    def closed(block: int, held: list[tuple], distinct: list[tuple]) -> Iterator[pd.DataFrame]:
        pairs, places, holders = np.unique(np.concatenate([d for d, _ in distinct]), return_inverse=True, return_counts=True)
        cuts = np.split(places.astype(np.int32), np.cumsum([len(d) for d, _ in distinct])[:-1])
        rows = [(block, *row, cut.tobytes(), n.astype(np.int32).tobytes(), None, None, None) for row, cut, (_, n) in zip(held, cuts, distinct, strict=True)]
        for k in range(0, len(rows), 1000):
            yield pd.DataFrame(rows[k : k + 1000], columns=names).astype({"doc_id": "Int64", "first": "Int64"})
        for k in range(0, len(pairs), CHUNK):
            row = (block, *[None] * 8, k, pairs[k : k + CHUNK], holders[k : k + CHUNK])
            yield pd.DataFrame([row], columns=names).astype({c: "Int64" for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = Tokenizers.of(path_a, path_b)
        block, held, distinct, read = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc, text, x in zip(pd.array(batch.doc_id, dtype="Int64"), batch.text, both.align(batch.text.tolist()), strict=True):
                digest = hashlib.sha256(both.groups_text(x)).hexdigest() if len(x.ids_a) else ""
                held.append((doc, len(x.ids_a), len(x.ids_b), len(x.shared), len(x.link_a), digest))
                distinct.append(np.unique(x.pairs(), return_counts=True))
                read += len(text or "") + 64
                if read >= size:
                    yield from closed(block, held, distinct)
                    block, held, distinct, read = block + 1, [], [], 0
        if held:
            yield from closed(block, held, distinct)

    kinds = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, first long, pairs array<long>, holders array<long>"
    return docs.select("doc_id", "text").mapInPandas(run, kinds)


def align_documents(docs: DataFrame, path_a: str, path_b: str, block: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for each row of docs (doc_id, text).

    A is encoded from space + text, B from the text, to which it adds the space itself; strings of special tokens are plain
    text. n_links counts the overlaps, n_best those whose pair of ids stands in as many documents as any pair of their A id,
    count_sum adds the numbers of documents of all links' pairs. A text that is null or empty, or whose tokens' bytes differ
    from space + text on either side, has zeros and an empty groups_sha256. Each row is a document: rows without doc_id and
    repeated ones count like others. Long texts are aligned whole, an empty table gives an empty one, other columns are left
    out. The result is a written table; those that lead to it are deleted.
    """
    spark = docs.sparkSession
    with temporary_tables(spark):
        with arrow_rows(spark, 512):
            table = written(_blocks(docs, path_a, path_b, block), "aligned")
        lists = table.where("pairs is not null").select("block", "first", F.posexplode(F.arrays_zip("pairs", "holders")).alias("k", "x"))
        lists = lists.select("block", (F.col("first") + F.col("k")).alias("place"), F.col("x.pairs").alias("pair"), F.col("x.holders").alias("n"))
        sums = written(lists.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
        best = written(sums.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("best")), "best")  # a row an A id at most
        answers = lists.select("block", "place", "pair").join(sums, "pair").withColumn("a", F.shiftright("pair", 32)).join(small_side(best), "a")
        answers = answers.select("block", "place", "count", (F.col("count") == F.col("best")).alias("is_best")).toDF("block", "place", "count", "is_best")
        keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        rows = table.where("pairs is null").select("block", *keep, "places", "times").toDF("block", *keep, "places", "times")

        def run(_: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
            counts, is_best = np.zeros(len(told), np.int64), np.zeros(len(told), np.int64)
            counts[told.place], is_best[told.place] = told["count"], told.is_best
            out = []
            for places, times in zip(rows.places, rows.times, strict=True):
                at, n = np.frombuffer(places, np.int32), np.frombuffer(times, np.int32).astype(np.int64)
                out.append((int(n @ is_best[at]), int(n @ counts[at])))
            ids = pd.array(rows.doc_id, dtype="Int64")
            return pd.concat([rows[keep].assign(doc_id=ids), pd.DataFrame(out, columns=["n_best", "count_sum"], index=rows.index, dtype="int64")], axis=1)

        kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
        out = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, kinds)
        return written(out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), "alignment", keep=True)
