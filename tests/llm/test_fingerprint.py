import hashlib
import random
import re
import unicodedata

import pytest
import xxhash
from pyspark.sql import functions as F

from quarryline.llm import fingerprint as fp

SCHEMA = "doc_id long, text string"


def form(text):
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return re.sub(r"\s+", " ", folded).strip(" ")


def r_of(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (h >> 63 << 64)


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0], r_of(x[1])), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        nxt, cut = rows[(k + 1) % len(rows)][1], len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), form(t), form(edited), form(nxt)))
    return out


def check(spark, rows):
    got = fp.compare_with_edits(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as r", "2 as h1")).collect()
    want = brute(rows)
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == sorted((*w[:3], float(w[3] == w[4]), float(w[3] == w[5])) for w in want)
    by = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in got}
    forms = {}
    for w in want:
        r = by[w[:3]]
        for f, d in ((w[3], r.fingerprint), (w[4], r.edited_fingerprint)):
            assert forms.setdefault(f, d) == d
    assert len(set(forms.values())) == len(forms)


def test_against_brute_force(spark):
    rng = random.Random(4)
    pool = ["Straße", "STRASSE", "ﬁn", "fin", "é", "é", "  x", "\t", "🙂", "ab", "Ab ", "ς Σ"]
    rows = [(i * rng.choice([1, 977]), " ".join(rng.choices(pool, k=rng.randrange(7)))) for i in range(-60, 300)]
    rows += [(10**15, None), (10**15 + 1, ""), (-(10**12), "same"), (5 * 10**12, "same"), (7, "z" * 100_000), (7, "y")]
    check(spark, list(dict(rows).items()) + [(7, "y")])
    check(spark, [(1, "one row")])
    check(spark, [(1, "ab"), (2, "AB"), (3, "ab"), (3, "ab")])


def test_bytes_decide_inside_equal_hashes(spark, monkeypatch):
    """With a hash of a few values only, fingerprints still tell all forms apart."""
    monkeypatch.setattr(fp, "hashes", lambda f: [F.length(f).cast("long") % 2, F.lit(0).cast("long")])
    check(spark, [(i, f"text {i % 7} {'x' * (i % 5)}") for i in range(40)])
    rows = [(i, f"t{i % 9}") for i in range(30)]
    got = dict(fp.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect())
    assert len({(got[i], t) for i, t in rows}) == len(set(got.values())) == 9


def test_rows_without_doc_id_and_empty_table(spark):
    got = fp.compare_with_edits(spark.createDataFrame([(None, "abc"), (None, None), (4, "abcdef")], SCHEMA)).collect()
    assert len(got) == 3
    alone = next(r for r in got if r.doc_id is None and r.n_chars == 3)
    assert alone.edited_sha256 == hashlib.sha256(b"ab").hexdigest() and alone.near_next == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert fp.compare_with_edits(empty).collect() == [] and fp.fingerprints(empty).collect() == []


def test_ties_and_repeated_rows_follow_each_other(spark):
    rng = random.Random(9)
    rows = [(rng.choice([5, 5, 5, k]), f"{k:05d} text{'y' * (k % 4)}") for k in range(900)] + [(5, "one row, many times")] * 700 + [(77, None)] * 400
    check(spark, rows)


@pytest.mark.parametrize("ids", [[*range(1, 20_000), 10**15], [-(2**63), *range(5000), 2**63 - 1], [7] * 8000 + [8], [1, 2, 3]])
def test_no_bucket_holds_many_rows(spark, ids):
    rows = spark.createDataFrame([(i, r_of(str(k))) for k, i in enumerate(ids)], "doc_id long, r long")
    segment, values, bucket, count = fp.rising_buckets(rows, 64, 1024)
    got = rows.withColumns(segment).withColumns(values).select("doc_id", "r", bucket.cast("long").alias("b")).collect()
    order = [r.b for r in sorted(got, key=lambda r: (r.doc_id, r.r))]
    assert order == sorted(order) and 0 <= order[0] and order[-1] < count
    assert max(order.count(b) for b in set(order)) < 400


def test_following_over_several_levels(spark):
    held = sorted(random.Random(3).sample(range(5000), 300))
    got = dict(fp.following(spark.createDataFrame([(b,) for b in held], "b long"), 5000, fan=8).collect())
    assert got == {b: held[k - 1] for k, b in enumerate(held)}
