import random

import numpy as np
import pytest
import xxhash

from quarryline.llm import simhash
from quarryline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text, size=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=3):
    """For each place the smallest place that links reach."""
    out = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and out[i] != out[j]:
                low, high = sorted((out[i], out[j]))
                out = [low if c == high else c for c in out]
    return out


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    groups = brute_components(fps)
    least = {}
    for (doc, _), g in zip(rows, groups, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return [(d, f"{f:016x}", least.get(g)) for (d, _), f, g in zip(rows, fps, groups, strict=True)]


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize(("shard", "block"), [(4096, 16384), (4, 16384), (16, 5)])
def test_against_brute_force(spark, shard, block):
    rng, texts = random.Random(11), []
    for _ in range(25):
        base = ["".join(rng.choices("abcdef", k=3)) for _ in range(rng.choice([2, 6, 30, 150]))]
        for _ in range(rng.choice([1, 3, 9])):
            texts.append(rng.choice([" ", "\t", "  ", "\x0b"]).join(base).title())
            base = [("x" if rng.random() < 0.02 else w) for w in base]
    texts += ["", None, " \n ", "one", "One two", "one  two", "Ünï cödé", "ünï cödé", "a\xa0b c d", "w " * 5000, "same words here", "Same Words here"]
    rng.shuffle(texts)
    rows = [(None if k % 13 == 5 else 500 - 3 * k, t) for k, t in enumerate(texts)] + [(500, texts[0]), (500, texts[0])]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as fp", "2 as first", "3 as component_id", "4 as shard").repartition(3)
    got = simhash.near_duplicates(docs, shard=shard, block=block).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute(rows)))


@pytest.mark.parametrize(("shard", "block"), [(64, 4096), (32, 40)])
def test_chains_balls_and_scattered_points(spark, shard, block):
    """Fingerprints made bit by bit: dense balls, chains of three-bit steps, points four bits apart."""
    rng = random.Random(3)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    points = [rng.getrandbits(64) for _ in range(500)]
    for n in (3, 4):
        points += [flip(p, n) for p in points[:100]]
    centre = rng.getrandbits(64)
    points += [flip(centre, rng.randrange(6)) for _ in range(400)]
    chain = [0]
    for _ in range(150):
        chain.append(flip(chain[-1], 3))
    points = sorted({*points, *chain, 0, 2**64 - 1})
    signed = [(p - (p >> 63 << 64),) for p in points]
    links = simhash.linked(spark.createDataFrame(signed, "fp long"), shard=shard, block=block).collect()
    assert all(((a ^ b) & 2**64 - 1).bit_count() <= 3 for a, b in links)
    place = {s[0]: k for k, s in enumerate(signed)}
    got = list(range(len(points)))
    for a, b in links:
        low, high = sorted((got[place[a]], got[place[b]]))
        got = [low if c == high else c for c in got]
    assert got == brute_components(points)


def test_shards_prune_and_lose_nothing():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    tree = simhash.Tree(points[:4000], 4)
    at, shard, own = tree.deal(points, 3)
    assert sorted(at[own].tolist()) == list(range(len(points))) and len(at) < 6 * len(points)
    assert np.bincount(shard[own], minlength=16).max() < len(points) / 4


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(key, QUERIES["op13_simhash"](spark, sf).collect())) == sorted(map(key, brute(rows)))
