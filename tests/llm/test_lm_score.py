import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quarryline.llm import lm_score as lm

SCHEMA = "doc_id long, text string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


class Tree:
    """Plain context-tree weighting: sequential counts, weights by recursion over contexts."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        self.older = defaultdict(set)
        for t in texts:
            row = bytes(depth) + t + b"\0"
            for i in range(depth, len(row)):
                for k in range(8):
                    bits = (k, row[i] >> (8 - k))
                    for d in range(depth + 1):
                        context = row[i - d : i]
                        self.n[context, bits][row[i] >> (7 - k) & 1] += 1
                        if d:
                            self.older[context[1:], bits].add(context)
        self.memo = {}

    def log_w(self, context, bits):
        if (context, bits) not in self.memo:
            a, b = self.n[context, bits]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(context) == self.depth:
                self.memo[context, bits] = own, 1.0
            else:
                below = sum(self.log_w(c, bits)[0] for c in sorted(self.older[context, bits]))
                top = max(own, below)
                both = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(below - top))
                self.memo[context, bits] = both, math.exp(own + math.log(0.5) - both)
        return self.memo[context, bits]

    def zero(self, row, i, bits):
        p = 0.5
        for d in range(self.depth, -1, -1):
            context = row[i - d : i]
            if (context, bits) in self.n:
                a, b = self.n[context, bits]
                w = self.log_w(context, bits)[1]
                p = w * (a + 0.5) / (a + b + 1) + (1 - w) * p
            else:
                p = 0.5
        return p

    def log10(self, text):
        row, total = bytes(self.depth) + text + b"\0", 0.0
        for i in range(self.depth, len(row)):
            for k in range(8):
                p = self.zero(row, i, (k, row[i] >> (8 - k)))
                total += math.log10(1 - p if row[i] >> (7 - k) & 1 else p)
        return total


def check(spark, rows, depth, **kw):
    got = lm.score_documents(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block"), depth, **kw).collect()
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    words = {t: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for _, t in rows}
    train = [(d, t) for d, t in rows if not held[d]]
    c = Counter(w for _, t in train for w in words[t])
    n, v = sum(c.values()), len(c)
    tree = Tree([lower(t).encode() for _, t in train], depth)
    want = []
    for d, t in rows:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words[t])
        want.append((d or -1, held[d], len(words[t]), sum(c[w] > 0 for w in words[t]), n, base, tree.log10(lower(t).encode())))
    assert len(got) == len(rows)
    order = lambda x: (x[0], x[2], round(x[5], 6), round(x[6], 6))
    for a, b in zip(sorted(((r[0] or -1, *r[1:7]) for r in got), key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6, abs=1e-6)


@pytest.mark.parametrize(("depth", "kw"), [(2, {}), (0, {}), (4, {"block_bytes": 300})])
def test_against_brute_force(spark, depth, kw):
    rng = random.Random(depth)
    pool = "the THE of straße É ab abc\x0b \x1c \x85 abc. 🙂 zz".split(" ")
    rows = [(i, " ".join(rng.choices(pool, k=rng.randrange(12)))) for i in range(60)]
    rows += [(61, None), (62, ""), (63, "x" * 50), (3, rows[3][1]), (None, "no id"), (70, "\x00\x00q"), (-4, "neg")]
    check(spark, rows, depth, **kw)


def test_nothing_to_learn_from(spark):
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    check(spark, [(alone, "ab c")], 2)
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_held_out_text_is_predicted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = lm.score_documents(docs).where("held_out").collect()
    assert sum(-r.score for r in rows) / math.log10(2) / sum(r.n_bytes + 1 for r in rows) < 4.5


def test_the_tree_predicts_held_out_text_better_than_the_unigram(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = lm.score_documents(docs).where("held_out").select("score", "base_score").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_default_depth_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices("the straße of É abcdefgh abcdefgi zz".split(), k=rng.randrange(12)))) for i in range(40)]
    check(spark, [*rows, (50, None), (51, "\x00" * 9 + "q")], lm.DEPTH, block_bytes=300)
