import random

import numpy as np
import pytest

from quarryline.llm import near_dup as nd

SCHEMA = "doc_id long, text string"


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").encode().split()
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)]


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


@pytest.mark.parametrize(("size", "large"), [(2, 256), (5, 256), (2, 3)])
def test_against_brute_force(spark, size, large):
    rng, rows = random.Random(size), []
    for _ in range(12):
        base = ["".join(rng.choices("klmnop", k=4)) for _ in range(rng.choice([1, 3, 8, 60, 200]))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            base = edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06]))
            rows.append(" ".join(base).title() if rng.random() < 0.3 else "\t".join(base))
    shared = " ".join(f"w{k}" for k in range(60))
    rows += [shared + " " + " ".join("".join(rng.choices("qrstuv", k=5)) for _ in range(rng.choice([10, 14, 20, 60]))) for _ in range(40)]
    rows += ["", None, "  ", "one", "One", "one two", "x " * 30_000, "É a", "é a"]
    rng.shuffle(rows)
    rows = [(i * 7 - 50, t) for i, t in enumerate(rows)]
    got = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node"), size=size, large=large).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, size, 80))


def test_repeated_rows_missing_ids_and_empty_table(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "q r"), (5, None)]
    got = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (0, 3, False), (3, 3, True), (3, 3, True), (5, 5, True)]
    assert nd.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pruning_keeps_to_its_miss_probability():
    need, rng = nd.least_matches(216, 0.8, 1e-3, 36), np.random.default_rng(1)
    same = rng.random((4000, 216)) < 0.8
    alive = np.ones(4000, bool)
    for k, least in enumerate(need):
        alive &= same[:, : 36 * (k + 1)].sum(axis=1) >= least
    assert alive.mean() > 0.99
    low = rng.random((4000, 216)) < 0.5
    assert (low[:, :36].sum(axis=1) >= need[0]).mean() < 0.2


def test_signatures_estimate_similarity():
    rng, by = np.random.default_rng(3), nd.multipliers(216)
    x = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = nd.signature(x[:900], by), nd.signature(x[100:], by)
    assert abs((a == b).mean() - 0.8) < 0.12


def test_near_copies_without_doc_id_take_part_in_links(spark):
    words = [f"w{k}" for k in range(100)]
    text = lambda k: " ".join([*words[: 100 - k], *(f"v{i}" for i in range(k))])
    rows = [(1, text(0)), (None, text(6)), (2, text(12)), (None, "quite another text than all of these others here"), (None, None)]
    out = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out)
    assert got == [(0, 0, True), (0, 0, True), (0, 1, False), (1, 1, True), (2, 1, False)]


def test_sets_that_share_a_hash_stay_apart(spark, monkeypatch):
    """With a node hash of a few values only, the second hash still tells all sets apart."""
    own = nd.xxhash.xxh3_128_intdigest
    monkeypatch.setattr(nd, "set_hash", lambda raw: own(raw) % (1 << 64) | (own(raw) >> 64) % 3 << 64)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*base[i % 4 :], f"x{i // 2}"]) if i % 3 else f"alone {i} a b c d") for i in range(30)] + [(40, "alone 0 a b c d"), (41, None)]
    got = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA), size=2).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 2, 80))


def test_recall_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for size in (2, 5):
        got = nd.near_duplicates(docs, size=size).collect()
        assert sorted(tuple(r) for r in got) == sorted(brute([tuple(r) for r in docs.collect()], size, 80))
