import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarryline.operators import retrieval, search


def test_containing_against_all_pairs(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcé/", k=rng.randrange(0, 14))) for _ in range(120)] + ["", "aaaa" * 500, "x[y]*"]
    needles = ["".join(rng.choices("abcé/", k=rng.randrange(1, 7))) for _ in range(60)] + ["", "[y]", "zzz", "aaaaaaaaa"]
    left = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = search.containing(left, "id", "t", spark.createDataFrame([(n,) for n in needles] * 2, "needle string"))
    assert sorted(map(tuple, got.collect())) == sorted((n, k) for n in set(needles) if n for k, t in enumerate(texts) if n in t)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert search.containing(left, "id", "t", spark.createDataFrame([], "needle string")).collect() == []


def test_names_resolve_without_limit_or_nested_loop(spark):
    nodes = spark.createDataFrame([("pkg/mod.Class",), ("pkg/mod.class",), ("other.Class#run",), ("Class",)], "id string")
    names = ["Class", "run", "CLASS", "mod.Cl", "mod.Class", "lass#r", "nothing", ""] + [f"missing {k}" for k in range(12_000)]
    got = {r.name: (r.id, r.tier) for r in retrieval.resolved(spark.createDataFrame([(n,) for n in names], "name string"), nodes).collect()}
    assert got == {"Class": ("Class", 0), "run": ("other.Class#run", 1), "CLASS": ("Class", 2), "mod.Cl": ("pkg/mod.Class", 3), "mod.Class": ("pkg/mod.Class", 1), "lass#r": ("other.Class#run", 3)}


def plain_tokens(text):
    out = []
    for token in re.findall(r"[A-Za-z_][A-Za-z0-9_]+", text):
        parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", token) if len(p) > 1]
        out += [token.lower(), *(parts if len(parts) > 1 else [])]
    return out


def brute_ranks(files, queries, k, boost):
    docs = {d: Counter(plain_tokens(" ".join([p.replace("/", " ")] * 3) + "\n" + t)) for d, p, t in files}
    df = Counter(w for c in docs.values() for w in c)
    idf = {w: math.log((1 + len(files)) / (1 + n)) + 1 for w, n in df.items()}

    def vector(counts):
        v = {w: (1 + math.log(n)) * idf[w] for w, n in counts.items() if w in idf}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / norm for w, x in v.items()}

    vectors, out = {d: vector(c) for d, c in docs.items()}, []
    for q, text in queries:
        asked, scores = vector(Counter(plain_tokens(text))), {}
        named = {x for x in re.findall(r"[A-Za-z_][A-Za-z0-9_]+", text) if len(x) >= 4 and ("_" in x or any(c.isupper() for c in x[1:]))}
        for d, p, t in files:
            s = sum(x * vectors[d].get(w, 0) for w, x in asked.items())
            if boost:
                stem = p.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                said = p.lower() in text.lower() or len(stem) >= 4 and stem not in search.GENERIC_STEMS and re.search(rf"\b{re.escape(stem.lower())}\b", text.lower())
                s += 1.0 * bool(said) + min(1.0, 0.35 * len(named & set(re.findall(r"(?m)^\s*(?:async\s+)?(?:def|class)\s+([A-Za-z_]\w*)", t))))
            if round(s, 9) > 0:
                scores[d] = round(s, 9)
        best = sorted(scores, key=lambda d: (-scores[d], d))[:k]
        out += [(q, d, scores[d], n) for n, d in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("boost", [False, True])
def test_ranks_equal_a_full_search(spark, boost):
    rng = random.Random(7)
    words = [f"w{k}{c}" for k in range(60) for c in ("x", "Yz", "_q")]
    pick = lambda n: " ".join(rng.choice(words[: rng.choice([4, 30, 180])]) for _ in range(n))
    files = []
    for k in range(300):
        defs = "".join(f"def {rng.choice(words)}(a):\n  pass\n" for _ in range(rng.randrange(3)))
        files.append((k, rng.choice(["src/", "lib/core/", ""]) + rng.choice([f"mod{k % 50}", "utils", "http-client", "x"]) + rng.choice([".py", ""]), pick(rng.randrange(40)) + "\n" + defs))
    queries = [(k, pick(rng.randrange(12)) + rng.choice(["", " see lib/core/utils.py", " in mod7 or Http-Client", " MOD12.PY"])) for k in range(25)] + [(99, ""), (98, "unknown terms only")]
    left = spark.createDataFrame(files, "doc long, path string, text string")
    right = spark.createDataFrame(queries, "q long, text string")
    got = search.ranked(search.indexed(left), right, 5, search.mentions(left, right) if boost else None).collect()
    assert sorted(map(tuple, got)) == sorted(brute_ranks(files, queries, 5, boost))


def test_ranking_reads_only_what_can_reach_the_top(spark):
    """A common term's long list stays unread when rarer terms decide."""
    files = [(k, "f", "common " + " ".join(f"u{k}_{j}" for j in range(6)) + (" rare" * 3 if k < 4 else "")) for k in range(2000)]
    index = search.indexed(spark.createDataFrame(files, "doc long, path string, text string"))
    out = search.ranked(index, spark.createDataFrame([(1, "rare common")], "q long, text string"), 3)
    assert [(r.doc, r.place) for r in out.orderBy("place").collect()] == [(0, 1), (1, 2), (2, 3)]


def test_long_texts_are_read_by_one_step_a_letter(spark):
    import time

    long = "ab🙂\ncé " * 300_000  # 2.1 million letters
    texts = spark.createDataFrame([(1, long), (2, "c\nd🙂xyz"), (3, "abc"), (4, None)], "k long, t string")
    needles = spark.createDataFrame([("🙂\ncé a",), ("\nd🙂x",), ("c",), ("🙂z",), ("",), ("é a",)], "needle string")
    start = time.monotonic()
    got = sorted(tuple(r) for r in search.containing(texts, "k", "t", needles).collect())
    assert got == sorted([("🙂\ncé a", 1), ("\nd🙂x", 2), ("c", 1), ("c", 2), ("c", 3), ("é a", 1)])
    assert time.monotonic() - start < 120


def brute_ego(edges, center, least, most):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    ego = {center} | near.get(center, set())
    if len(ego) < least:
        ego |= {y for x in near.get(center, ()) for y in near[x]}
    return sorted(ego, key=lambda n: (n != center, -len(near.get(n, ())), n))[:most]


@pytest.mark.parametrize(("least", "most"), [(8, 40), (4, 3)])
def test_ego_graphs_against_brute_force(spark, least, most):
    rng = random.Random(least)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(180)] + [(0, k) for k in range(100, 150)] + [(200, 0), (5, 5), (201, 202)] * 2
    centers = [*range(0, 150, 7), 200, 201, 300]
    got = retrieval.ego_graphs(spark.createDataFrame(edges, "source long, target long"), spark.createDataFrame([(c,) for c in centers], "node long"), least, most).collect()
    for c in centers:
        assert [r.node for r in sorted(got, key=lambda r: r.place) if r.center == c] == brute_ego(edges, c, least, most)


def test_ego_graphs_follow_neighbours_that_are_left_out(spark):
    rng = random.Random(3)  # the hubs 900 to 919 are reached by leaves of low degree alone, which are not among the most
    edges = [(0, k) for k in range(1, 81)] + [(k, 900 + k // 4) for k in range(1, 81)] + [(900 + h, 1000 + rng.randrange(200)) for h in range(21) for _ in range(60)]
    edges += [(k, 2000 + k * 10 + j) for k in range(1, 11) for j in range(4)]
    got = retrieval.ego_graphs(spark.createDataFrame(edges, "source long, target long"), spark.createDataFrame([(0,), (900,), (7,)], "node long"), 1 << 40, 10).collect()
    for c in (0, 900, 7):
        assert [r.node for r in sorted(got, key=lambda r: r.place) if r.center == c] == brute_ego(edges, c, 1 << 40, 10)


def test_shards_of_wide_rows_lose_none(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    parts = [retrieval.sharded(docs, "doc_id", k, 7) for k in (0, 3)]
    assert [sorted(r.doc_id for r in p.select("doc_id").collect()) for p in parts] == [list(range(k, docs.count(), 7)) for k in (0, 3)]
    same = spark.range(1000).selectExpr("1 as k", "id % 10 as v", "map(id, id) as m")
    rows = [retrieval.sharded(same, "k", k, 3).count() for k in range(3)]
    assert rows == [334, 333, 333] and np.sum(rows) == 1000


def test_postings_of_asked_terms_rank_like_all(spark):
    """An index for some queries lists their terms alone, and weights, hence ranks, are those of the whole index."""
    files = spark.createDataFrame([(k, f"dir/f{k}", " ".join(f"word{k % m} other{k}" for m in (2, 3, 5, 7))) for k in range(60)], "doc long, path string, text string")
    queries = spark.createDataFrame([(1, "word1 word2 missing"), (2, "other7 word4")], "q long, text string")
    whole, own = search.indexed(files), search.indexed(files, asked=queries)
    asked = {t for r in queries.select(search.code_tokens(queries.text).alias("t")).collect() for t in r.t}
    terms = lambda index: {r.term for r in index.postings.select("term").distinct().collect()}
    assert terms(own) == terms(whole) & asked < terms(whole)
    rows = lambda index: sorted(tuple(r) for r in search.ranked(index, queries, 10).collect())
    assert rows(own) == rows(whole) and len(rows(own)) == 20


def test_a_common_definition_is_not_met_with_all_its_queries(spark):
    """Files that share a definition are no candidates of every query that names it, where better ones are known; needles of any length are found."""
    files = [(k, f"src/some/long/folder/module_{k}.py", f"def common_name():\n  pass\ndef own_{k // 20}_name():\n  pass") for k in range(3000)]
    queries = [(q, f"common_name and own_{q}_name fail in src/some/long/folder/module_{q}.py") for q in range(40)]
    left, right = spark.createDataFrame(files, "doc long, path string, text string"), spark.createDataFrame(queries, "q long, text string")
    boosts = search.mentions(left, right)
    assert boosts.told.count() == 40
    got = search.ranked(search.indexed(left, asked=right), right, 3, boosts)
    assert sorted(map(tuple, got.collect())) == sorted(brute_ranks(files, queries, 3, True))
