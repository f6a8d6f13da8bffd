"""Context-tree weighting over bytes, and a unigram base, learnt and applied by exchanging compressed count lists.

The tree has the contexts of 0 to DEPTH bytes. A byte is eight binary decisions; each (context, decided bits) node mixes its
Krichevsky-Trofimov estimate with its children's, one byte further back, by the weights that the training text gives
(half to each before it). Block probabilities depend on counts alone, so training needs no order.

Documents are laid out in blocks of bounded size. A block lists its distinct words and n-grams once, with training counts, as
sorted compressed arrays, one for each part: a part holds whole subtrees, chosen by the TOP bytes next to the predicted one.
A part merges the lists of all blocks and has all that the subtrees' weights depend on; the few nodes above the subtrees (at
most 255 * 256 ** (TOP - 1) of them) are summed over parts and sent to all. Each part then answers every block with the values of
the block's own n-grams. No table of the corpus is collected or broadcast, and words are told apart by their bytes.
"""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import written
from quarryline.llm.quality import Lookup, ngrams

DEPTH, TOP, BLOCK_BYTES, CHUNK_BYTES, PART_BYTES, FOLDS, HELD_OUT = 6, 2, 20 << 20, 1 << 20, 20 << 20, 7, 2
WORD, GRAM = 0, 1
LN2 = math.log(2)


def packed(values: np.ndarray) -> bytes:
    """An array's bytes, plane by plane, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def rising(values: np.ndarray) -> bytes:
    """Sorted unsigned integers, by their differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def risen(data: bytes, kind: type) -> np.ndarray:
    return unpacked(data, kind).cumsum(dtype=kind)


def lowered(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased. Its parts between white space (0x20, 0x09 to 0x0D) are the words."""
    return text.encode("utf-8", "replace").lower()


CHUNKS = "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, data binary"


def in_blocks(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """Lower-cased texts in reading order, as compressed chunks of about CHUNK_BYTES in blocks of about size bytes."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, before, rows, held = random.getrandbits(40) << 22, 0, [], 0

        def chunk(block: int) -> pd.DataFrame:
            ids, folds, texts = zip(*rows, strict=True)
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pd.DataFrame({"block": [base + block], "doc_ids": [ids], "held": [folds], "sizes": [[len(t) for t in texts]], "data": [data]})

        for batch in batches:
            for doc_id, text, fold in zip(batch.doc_id.astype("Int64").tolist(), batch.text, batch.held.tolist(), strict=True):
                rows.append((None if doc_id is pd.NA else doc_id, bool(fold), lowered(text)))
                held += len(rows[-1][2])
                if held >= min(CHUNK_BYTES, size) or len(rows) >= 100_000:
                    yield chunk(before // size)
                    before, rows, held = before + held, [], 0
        if rows:
            yield chunk(before // size)

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held"))
    rows = rows.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // size)))
    return written(rows.mapInPandas(run, CHUNKS), "blocks")


def texts_of(row) -> list[bytes]:
    data, ends = zstandard.ZstdDecompressor().decompress(row.data), np.cumsum(row.sizes).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def context_first(grams: np.ndarray) -> np.ndarray:
    """N-grams with the byte next to the predicted one on top and the predicted byte last: sorted, every context is one range."""
    swapped = grams.byteswap()
    return swapped << np.uint64(8) | swapped >> np.uint64(56)


def block_lists(blocks: DataFrame, depth: int, top: int, parts: int) -> DataFrame:
    """(part, kind, block, keys, counts): the distinct words and n-grams of each block with their training counts."""

    def merged(grams: list) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([g for g, _ in grams])
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        n = np.concatenate([n for _, n in grams])[order]
        return keys[first], np.add.reduceat(n, first) if len(keys) else n

    class Block:
        """What a block has so far. N-grams lie in ranges, which are merged one by one, so that little is held twice."""

        def __init__(self) -> None:
            self.words: dict[bytes, int] = defaultdict(count().__next__)
            self.counts, self.pending = np.zeros(1 << 16, np.int64), 0
            self.bounds: np.ndarray | None = None

        def add(self, texts: list[bytes], held: bool) -> None:
            seen = np.fromiter((self.words[w] for t in texts for w in t.split()), np.int64)
            if len(self.words) > len(self.counts):
                self.counts = np.concatenate([self.counts, np.zeros(len(self.words), np.int64)])
            if not held:
                self.counts += np.bincount(seen, minlength=len(self.counts))
            own, begin, end = ngrams(texts, depth + 1)
            inner = np.zeros(len(own) + 1, np.int8)
            inner[begin] += 1
            inner[end] -= 1
            keys, n = np.unique(context_first(own[inner[:-1].cumsum(dtype=np.int8) > 0]), return_counts=True)
            if self.bounds is None:
                self.bounds = np.unique(keys[np.arange(1, 16) * len(keys) // 16])
                self.ranges: list[list] = [[] for _ in range(len(self.bounds) + 1)]
            n = (n * (not held)).astype(np.int32)
            cuts = [0, *np.searchsorted(keys, self.bounds).tolist(), len(keys)]
            for own_range, x, y in zip(self.ranges, cuts, cuts[1:], strict=False):
                own_range.append((keys[x:y].copy(), n[x:y].copy()))
            self.pending += 1
            if self.pending > 6:
                self.ranges, self.pending = [[merged(r)] for r in self.ranges], 0

        def lists(self, block: int) -> Iterator[pd.DataFrame]:
            frame = lambda *row: pd.DataFrame([row], columns=["part", "kind", "block", "keys", "counts"])
            own: dict[int, list] = defaultdict(list)
            for k, w in enumerate(self.words):
                own[zlib.crc32(w) % parts].append((w, k))
            for part, words in own.items():
                yield frame(part, WORD, block, zstandard.compress(b"\n".join(w for w, _ in words), 1), packed(self.counts[[k for _, k in words]]))
            pieces: dict[int, list] = defaultdict(list)
            for k in range(len(self.ranges)):
                (keys, n), self.ranges[k] = merged(self.ranges[k]), []
                if not len(keys):
                    continue
                dealt = (subtree(keys, top) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts)
                order = np.argsort(dealt, kind="stable")
                held, first = np.unique(dealt[order], return_index=True)
                for part, at in zip(held.tolist(), np.split(order, first[1:]), strict=True):
                    pieces[part].append((keys[at], n[at]))
            while pieces:
                part, own_grams = pieces.popitem()
                keys, n = (np.concatenate(x) for x in zip(*own_grams, strict=True))
                yield frame(part, GRAM, block, rising(keys), packed(n.astype(np.int64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, made = None, Block()
        for batch in batches:
            for row in batch.itertuples():
                if now is not None and row.block != now:
                    yield from made.lists(now)
                    made = Block()
                now, texts = row.block, texts_of(row)
                for held in (False, True):
                    if some := [t for t, h in zip(texts, row.held, strict=True) if h == held]:
                        made.add(some, held)
        if now is not None:
            yield from made.lists(now)

    return blocks.select("block", "held", "sizes", "data").mapInPandas(run, "part long, kind tinyint, block long, keys binary, counts binary")


def subtree(keys: np.ndarray, top: int) -> np.ndarray:
    """The top context bytes of n-grams that begin with them."""
    return keys >> np.uint64(64 - 8 * top) if top else np.zeros(len(keys), np.uint64)


#: ln Gamma(k / 2) for small k
HALVES = np.array([0.0, *(math.lgamma(k / 2) for k in range(1, 20_000))])


def ln_gamma(doubled: np.ndarray) -> np.ndarray:
    """ln of the gamma function of half of each integer; by Stirling's series for large ones."""
    at = doubled.astype(np.int64)
    out = HALVES[np.minimum(at, len(HALVES) - 1)]
    large = at >= len(HALVES)
    if large.any():
        x = at[large] / 2
        out[large] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def log_estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a block with these counts."""
    return ln_gamma(2 * n0 + 1) + ln_gamma(2 * n1 + 1) - ln_gamma(2 * (n0 + n1) + 2) - math.log(math.pi)


def mixed(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln of the weighted probability of nodes, and the share of their own estimate in it."""
    log_w = np.logaddexp(own, below) - LN2
    return log_w, np.exp(own - LN2 - log_w)


class Subtrees:
    """The nodes of depths top to depth over sorted n-grams (context first) and their counts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> None:
        self.top, self.keys, self.n, self.up = top, [keys], [n], []
        for d in range(depth - 1, top - 1, -1):
            context = ~((1 << (64 - 8 * d)) - 1) & ((1 << 64) - 1) if d else 0
            shorter, up = np.unique(self.keys[-1] & np.uint64(context | 255), return_inverse=True)
            self.n.append(np.bincount(up, self.n[-1], len(shorter)).astype(np.int64))
            self.keys.append(shorter)
            self.up.append(up)

    def bit(self, k: int) -> Iterator[tuple]:
        """For each level from the deepest: each row's node, nodes' first rows, counts, log weights and shares of the own estimate."""
        log_w = below = before = None
        for level, (keys, n) in enumerate(zip(self.keys, self.n, strict=True)):
            byte = keys & np.uint64(255)
            node = keys & ~np.uint64(255) | byte >> np.uint64(8 - k)
            new = np.ones(len(keys), bool)
            new[1:] = node[1:] != node[:-1]
            first, at = np.flatnonzero(new), new.cumsum() - 1
            n1 = np.add.reduceat(n * (byte >> np.uint64(7 - k) & np.uint64(1)).astype(np.int64), first)
            n0 = np.add.reduceat(n, first) - n1
            own = log_estimate(n0, n1)
            if level:
                below = np.bincount(at[self.up[level - 1][before]], log_w, len(first))
                log_w, share = mixed(own, below)
            else:
                log_w, share = own, np.ones(len(first))
            before = first
            yield at, first, n0, n1, log_w, share

    def roots(self, k: int, first: np.ndarray) -> np.ndarray:
        """Numbers of the nodes one level above the subtrees: context and decided bits with a leading 1."""
        keys = self.keys[-1][first]
        bits = np.uint64(1 << k) | (keys & np.uint64(255)) >> np.uint64(8 - k)
        return (subtree(keys, self.top - 1) << np.uint64(8) | bits).astype(np.int64)

    def add_roots(self, sums: np.ndarray) -> None:
        """Add counts and log weights to sums (3 x nodes above)."""
        for k in range(8):
            *_, (_, first, n0, n1, log_w, _) = self.bit(k)
            at = self.roots(k, first)
            for row, values in zip(sums, (n0, n1, log_w), strict=True):
                row += np.bincount(at, values, len(row))

    def log10(self, above: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
        """log10 of the probability of each n-gram's last byte after its context."""
        out = np.zeros(len(self.keys[0]))
        last = self.keys[0] & np.uint64(255)
        for k in range(8):
            p, row = None, np.arange(len(out))
            for level, (at, first, n0, n1, _, share) in enumerate(self.bit(k)):
                row = self.up[level - 1][row] if level else row
                node = at[row]
                own = ((n0 + 0.5) / (n0 + n1 + 1))[node]
                p = share[node] * own + (1 - share[node]) * p if level else own
            if above is not None:
                root = self.roots(k, first)[node]
                p = above[0][root] + above[1][root] * p
            out += np.log10(np.where(last >> np.uint64(7 - k) & np.uint64(1), 1 - p, p))
        return out


def ranges(keys: np.ndarray, top: int, size: int = 200_000) -> Iterator[slice]:
    """Ranges of whole subtrees, of about size n-grams or one subtree."""
    own = subtree(keys, top)
    starts = np.flatnonzero(np.diff(own, prepend=~own[:1])) if len(own) else np.zeros(0, np.int64)
    begin = 0
    for a in [*starts[1:].tolist(), len(keys)]:
        if a - begin >= size or a == len(keys):
            yield slice(begin, a)
            begin = a


PARTS = "part long, kind tinyint, keys binary, counts binary, blocks array<long>, lists array<binary>, own array<binary>, above binary, total long, n_distinct long"


def merged_parts(lists: DataFrame, depth: int, top: int) -> DataFrame:
    """One row for each part and kind: merged n-grams and counts; what each block holds of them; sums for the nodes above.

    Of words each block's list and counts are kept as they are to be sent back; of n-grams, their places in the merged list.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blocks = rows.block.tolist()
        if key[1] == WORD:
            n: dict[bytes, int] = defaultdict(int)
            words = [zstandard.decompress(x).split(b"\n") for x in rows["keys"]]
            for ws, x in zip(words, rows["counts"], strict=True):
                for w, c in zip(ws, unpacked(x, np.int64).tolist(), strict=True):
                    n[w] += c
            own = [packed(np.fromiter(map(n.__getitem__, ws), np.int64, len(ws))) for ws in words]
            made = (*key, None, None, blocks, rows["keys"].tolist(), own, None, sum(n.values()), sum(c > 0 for c in n.values()))
        else:
            parts = [risen(x, np.uint64) for x in rows["keys"]]
            keys, at = np.unique(np.concatenate(parts), return_inverse=True)
            n = np.bincount(at, np.concatenate([unpacked(x, np.int64) for x in rows["counts"]]), len(keys)).astype(np.int64)
            own = [rising(x.astype(np.uint32)) for x in np.split(at, np.cumsum([len(p) for p in parts])[:-1])]
            above = None
            if top:
                sums = np.zeros((3, 256**top))
                for some in ranges(keys, top):
                    Subtrees(keys[some], n[some], depth, top).add_roots(sums)
                above = packed(sums.ravel())
            made = (*key, rising(keys), packed(n), blocks, [], own, above, 0, 0)
        return pd.DataFrame([made], columns=[c.split()[0] for c in PARTS.split(", ")])

    return written(lists.groupBy("part", "kind").applyInPandas(run, PARTS), "parts")


def nodes_above(parts: DataFrame, top: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(a, b) of each node one level above the subtrees: with q from below, the whole path predicts a + b * q."""
    if not top:
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((3, 256**top))
        for batch in batches:
            for data in batch.above:
                sums += unpacked(data, np.float64).reshape(sums.shape)
        held = np.flatnonzero(sums[0] + sums[1])
        yield pd.DataFrame({"node": held, "n0": sums[0, held], "n1": sums[1, held], "below": sums[2, held]})

    rows = parts.where(F.col("kind") == GRAM).select("above").mapInPandas(run, "node long, n0 double, n1 double, below double")
    rows = rows.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "below"))).toPandas()  # at most 255 * 256 ** (top - 1)
    n0, n1, below = np.zeros((3, 256**top))
    for values, name in ((n0, "n0"), (n1, "n1"), (below, "below")):
        values[rows["node"].to_numpy(np.int64)] = rows[name].to_numpy()
    levels = []
    for t in range(top - 1, -1, -1):
        log_w, share = mixed(log_estimate(n0, n1), below)
        levels.append((share, (n0 + 0.5) / (n0 + n1 + 1)))
        if t:
            n0, n1, below = (x.reshape(-1, 256, 256).sum(axis=1).ravel() for x in (n0, n1, log_w))
    a, b = np.zeros(256), np.ones(256)
    for t, (share, own) in enumerate(reversed(levels)):
        if t:
            a, b = (np.repeat(x.reshape(-1, 1, 256), 256, axis=1).ravel() for x in (a, b))
        a, b = a + b * share * own, b * (1 - share)
    return a, b


def answers_of(parts: DataFrame, above: tuple[np.ndarray, np.ndarray] | None, depth: int, top: int) -> DataFrame:
    """(block, kind, keys, values): training counts of each block's words and log10 probabilities of its n-grams."""
    held = parts.sparkSession.sparkContext.broadcast(above)  # two numbers for each node above the subtrees

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                if row.kind == WORD:
                    out = list(zip(row.lists, row.own, strict=True))
                else:
                    keys, n = risen(row.keys, np.uint64), unpacked(row.counts, np.int64)
                    values = [Subtrees(keys[some], n[some], depth, top).log10(held.value) for some in ranges(keys, top)]
                    values = np.concatenate(values).astype(np.float32)
                    own = [risen(x, np.uint32) for x in row.own]
                    out = [(rising(keys[at]), packed(values[at])) for at in own]
                yield pd.DataFrame({"block": row.blocks, "kind": row.kind, "keys": [k for k, _ in out], "values": [v for _, v in out]})

    return parts.select("kind", "keys", "counts", "blocks", "lists", "own").mapInPandas(run, "block long, kind tinyint, keys binary, values binary")


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"


def score_documents(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """Scores of all rows of docs (doc_id, text), learnt from those whose crc32(doc_id as text) mod 7 is not 2.

    held_out; n_tokens, words and one end; n_known, those that training has; train_tokens; base_score, log10 of the add-one
    unigram; score, log10 of the tree's probability of the text's bytes and end; n_bytes and bits_per_byte of that. A null
    text counts as empty and a row without doc_id as training. Repeated rows count and are scored each; an empty table gives
    none; texts of any length are scored whole. Without training rows every byte has probability 1/256. Other columns are
    left out. depth is 7 at most, so that an n-gram is one 64-bit integer.
    """
    if not 0 <= depth <= 7:
        raise ValueError("depth must lie between 0 and 7")
    top = min(TOP, depth)
    blocks = in_blocks(docs, block_bytes)
    ends, size = blocks.select(F.size(F.filter("held", lambda h: ~h)).alias("e"), F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("s")).agg(F.sum("e"), F.sum("s")).first()
    ends, size = ends or 0, size or 0
    parts = merged_parts(block_lists(blocks, depth, top, max(1, -(-size // part_bytes))), depth, top)
    total, distinct = parts.agg(F.sum("total"), F.sum("n_distinct")).first()
    train_tokens, vocabulary = (total or 0) + ends, (distinct or 0) + (ends > 0)
    answers = answers_of(parts, nodes_above(parts, top), depth, top)
    norm = math.log10(train_tokens + vocabulary + 1)

    def run(chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        n: dict[bytes, int] = {}
        for row in answers[answers.kind == WORD].itertuples():
            n.update(zip(zstandard.decompress(row.keys).split(b"\n"), unpacked(row.values, np.int64).tolist(), strict=True))
        grams = answers[answers.kind == GRAM]
        del answers
        lookup = Lookup(np.concatenate([risen(x, np.uint64) for x in grams["keys"]]), np.concatenate([unpacked(x, np.float32) for x in grams["values"]]), 1)
        del grams
        parts = []
        for row in chunks.itertuples():
            raw = texts_of(row)
            words = [t.split() for t in raw]
            c = np.fromiter((n[w] for ws in words for w in ws), np.int64)
            sums = np.concatenate([[0.0], np.log10(c + 1).cumsum()])
            known = np.concatenate([[0], (c > 0).cumsum()])
            last = np.cumsum([len(w) for w in words])
            first = last - [len(w) for w in words]
            grams, begin, end = ngrams(raw, depth + 1)
            cost = np.concatenate([[0.0], lookup.find(context_first(grams))[0].cumsum(dtype=np.float64)])
            tokens = last - first + 1
            parts.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(row.doc_ids, dtype="Int64"),
                        "held_out": row.held,
                        "n_tokens": tokens,
                        "n_known": known[last] - known[first] + (ends > 0),
                        "train_tokens": train_tokens,
                        "base_score": sums[last] - sums[first] + math.log10(ends + 1) - tokens * norm,
                        "score": cost[end] - cost[begin],  # the padding between texts is summed too, and taken out here
                        "n_bytes": row.sizes,
                    }
                )
            )
        out = pd.concat(parts, ignore_index=True)
        out["bits_per_byte"] = -out["score"] / math.log10(2) / (out["n_bytes"] + 1)
        return out

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, SCHEMA)
