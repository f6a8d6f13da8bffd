import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarryline.llm import packing
from quarryline.llm.queries import word_vocabulary

ODD = [
    "it's I'LL don't 's 'S x's", "a\x1c!\x1c!", "“word”. ok", "İstanbul ΣΑΣ ς É É.", "a b\xa0c\x85d", "x<|endoftext|>y z",
    "é ́x", "1234 a1b2 **a**", "\x00\x1f!!a!!", "", "🙂!a🙂.", "ﬁ ½ ǅ", "a`b~ c^d' e'. 're.", "A'LL.", "THE THE, the. straße.",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_vocabulary())


def test_ids_are_the_tokenizers_own(tokenizer):
    own = packing.WordTokenizer(word_vocabulary())
    for text in ODD * 2:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_are_placed_whole_and_gapless(spark, tokenizer):
    texts = [*ODD, None, "word " * 5000, "word " * 4095, "same", "same"] + [f"w{i} " * (i * 37 % 900) for i in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as bin", "'x' as shard")
    got = packing.pack(packing.tokenise(docs, word_vocabulary()), shard=50).collect()
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda r: (r[0] is None, *(x or 0 for x in r))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= sum(w[3] for w in want) / 4096 * 1.05 + 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.tokenise(docs, word_vocabulary())).collect() == []


def test_sum_of_squares_against_brute_force():
    rng = np.random.default_rng(5)
    sizes, cap = rng.integers(1, 21, 200), 20
    got = packing.sum_of_squares(sizes, cap)
    fill: dict[int, int] = {}
    for a, b in zip(sizes.tolist(), got.tolist(), strict=True):
        def cost(target):
            trial = dict(fill)
            trial[target] = trial.get(target, 0) + a
            gaps = defaultdict(int)
            for f in trial.values():
                if f < cap:
                    gaps[f] += 1
            return sum(n * n for n in gaps.values())
        options = {t: cost(t) for t in [x for x, f in fill.items() if f + a <= cap] + [len(fill)]}
        assert options[b] == min(options.values())
        fill[b] = fill.get(b, 0) + a
    assert max(fill.values()) <= cap
