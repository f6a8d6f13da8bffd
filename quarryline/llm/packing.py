"""Sum-of-squares packing of tokenised documents into sequences of fixed length.

Documents are tokenised once, cut only where longer than a sequence, and dealt in random shards of a bounded number of
pieces. A shard places its pieces from long to short. With N(g) open sequences of residual gap g, a piece goes where the
sum of N(g) squared becomes smallest: into an open sequence or a new one; of equal choices the tightest fit. Sequences
that are left with room are then opened again: they are placed whole into each other, over shards, by the same rule.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import written

LENGTH, END_ID, SHARD, CACHE = 4096, 1, 16384, 400_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest in order from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordTokenizer:
    """Ids of whole texts, as little-endian bytes, from a cache of words.

    For vocabularies that lower-case, split at white space and between letters and other characters, and mark word ends,
    as word_bpe_49k.json does. A text's ids are those of its parts between ASCII white space. A part made of Latin-1
    letters and then ASCII punctuation splits there; its letters go through the merges directly, with an own byte for each
    byte at a word's end. Any other part goes to the tokenizer, and a text that holds a special token's string does so as
    a whole. The cache is bounded and starts anew when full.
    """

    PLAIN = re.compile("([a-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")
    _of: dict[str, WordTokenizer] = {}

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[bytes, bytes] = {}
        # letters' bytes, and the bytes that stand for them at a word's end
        inner = [*range(97, 123), *range(128, 192), *range(194, 245)]
        self.ends = dict(zip([*range(97, 123), *range(128, 192)], [*range(65, 91), *range(64)], strict=True))
        chars, ranks = byte_chars(), {}
        for token, rank in self.tokenizer.get_vocab().items():
            if token in self.special:
                continue
            stem = token.removesuffix("</w>")
            raw = [chars.get(c, 0) for c in stem]
            if stem and all(b in inner for b in raw) and (stem == token or raw[-1] in self.ends):
                if stem != token:
                    raw[-1] = self.ends[raw[-1]]
                ranks[bytes(raw)] = rank
        for b in {*range(256)} - {r[0] for r in ranks if len(r) == 1}:
            ranks[bytes([b])] = (1 << 30) + b  # never met in a word
        self.packed = {rank: rank.to_bytes(4, "little") for rank in ranks.values()}
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """One for each Python worker, so that its cache serves all tasks there."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _letters(self, word: str) -> bytes:
        raw = word.lower().encode()
        return b"".join(map(self.packed.__getitem__, self.merge(raw[:-1] + bytes((self.ends[raw[-1]],)))))

    def _learn(self, words: set[bytes]) -> None:
        cache, other = self.cache, []
        for w in words:
            if m := self.PLAIN.fullmatch(w.decode()):
                tail = m[2].encode()
                if tail and tail not in cache:
                    cache[tail] = self._whole([m[2]])[0]
                cache[w] = self._letters(m[1]) + (cache[tail] if tail else b"")
            else:
                other.append(w)
        if other:
            cache.update(zip(other, self._whole([w.decode() for w in other]), strict=True))

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole([text])[0]
        words = text.encode("utf-8", "replace").lower().split()
        try:
            return b"".join(map(self.cache.__getitem__, words))
        except KeyError:
            if len(self.cache) > CACHE:
                self.cache.clear()
            self._learn({w for w in words if w not in self.cache})
            return b"".join(map(self.cache.__getitem__, words))


def tokenise(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32. A null text counts as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, end = WordTokenizer.of(vocabulary), np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.doc_id, batch.text, strict=True):
                ids = tok.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    out.append((None if pd.isna(doc_id) else doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            pieces = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pieces.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, PIECES)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item, in the order given. Sizes lie between 1 and capacity."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap; a full bin is not open
    open_bins: dict[int, list[int]] = defaultdict(list)
    out, bins = np.empty(len(sizes), np.int64), 0
    for i, a in enumerate(sizes.tolist()):
        # change of the sum of squares, halved, for each gap that the item fits; full bins don't count
        best, gain = -1, count[capacity - a] + 0.5 if a < capacity else 0.0
        own = count[a:capacity]
        held = np.flatnonzero(own)
        if len(held):
            change = count[held] - own[held] + 1.0
            if held[0] == 0:
                change[0] = 0.5 - own[0]
            k = int(np.argmin(change))
            if change[k] <= gain:
                best = int(held[k]) + a
        if best < 0:
            b, best, bins = bins, capacity, bins + 1
        else:
            b = open_bins[best].pop()
            count[best] -= 1
        out[i], left = b, best - a
        if left:
            open_bins[left].append(b)
            count[left] += 1
    return out


def pack(pieces: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Add sequence_id and offset. Each row is placed, repeated ones too; offsets in a sequence are gapless from 0.

    Pieces of equal length are placed in order of doc_id, piece and ids; equal rows are told apart by nothing, so any of them
    may stand anywhere. Rows are dealt to shards by their place in the written table, so equal rows spread as others do. An
    empty table gives an empty result. Other columns are left out.
    """
    pieces = written(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        rows["bin"] = sum_of_squares(rows["length"].to_numpy(), length)
        rows["offset"] = rows.groupby("bin")["length"].cumsum() - rows["length"]
        rows["bin"] += int(key[0]) << 32
        return rows[["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset"]]

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    placed = written(dealt.groupBy("shard").applyInPandas(place, PIECES + ", bin long, offset long"), "placed")

    # sequences with room, placed whole into each other: bins of all shards, dealt anew
    fill = placed.groupBy("bin").agg(F.sum("length").alias("length")).where(F.col("length") <= length - 1)
    rest = fill.withColumn("shard", F.pmod(F.xxhash64("bin"), F.lit(max(1, shards // 16))))

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "bin"], ascending=[False, True])
        rows["into"] = sum_of_squares(rows["length"].to_numpy(), length)
        rows["shift"] = rows.groupby("into")["length"].cumsum() - rows["length"]
        rows["into"] = rows.groupby("into")["bin"].transform("first")
        return rows[["bin", "into", "shift"]]

    moved = rest.groupBy("shard").applyInPandas(join, "bin long, into long, shift long").where("bin <> into")
    return placed.join(moved, "bin", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
