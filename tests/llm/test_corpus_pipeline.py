import re
from collections import defaultdict

import corpus_pipeline as cp
from tests_brute import components, shingle_sets


def test_stages_on_the_smallest_tables(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = before = spark.read.parquet(f"{sf}/documents.parquet")
    steps = []
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        steps.append(docs)
        if k < 3:
            assert docs.columns == before.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[0].collect()}
    assert sum(d in kept for d, q in labels.items() if q) >= 0.97 * sum(labels.values())
    assert sum(d in kept for d, q in labels.items() if not q) <= 0.1 * sum(not q for q in labels.values())
    rows = sorted((r.doc_id, r.text) for r in steps[0].collect())
    groups = components([d for d, _ in rows], shingle_sets([t for _, t in rows], 5), 80)
    assert {r.doc_id for r in steps[1].collect()} == {min(g) for g in groups}
    plain = lambda t: f" {' '.join(re.findall(r'[a-z0-9]+', t.lower()))} "
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in steps[1].collect() if not any(i in plain(r.text) for i in items)}
    assert {r.doc_id for r in steps[2].collect()} == clean
    bins = defaultdict(int)
    for r in steps[3].collect():
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 4096 and {r.doc_id for r in steps[3].collect()} == clean


def test_repeated_and_missing_ids(spark):
    from quarryline.llm.near_dup import deduplicate

    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (None, "a b c d e f g", "y"), (None, None, "z"), (1, "other words stand here for once", "x")]
    out = deduplicate(spark.createDataFrame(rows, "doc_id long, text string, doc_id_ string"))
    assert out.columns == ["doc_id", "text", "doc_id_"]
    assert sorted(r.text or "" for r in out.collect()) == ["", "a b c d e f g", "other words stand here for once"]


def test_run_gives_what_its_stages_give(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    out = cp.run(spark, sf).collect()
    assert out and len({(r.doc_id, r.piece) for r in out}) == len(out)
    spans = defaultdict(list)
    for r in out:
        spans[r.sequence_id].append((r.offset, r.length))
    for parts in spans.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 4096


def test_stages_on_empty_tables_odd_rows_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, quality_score string, kept string, leaks string, node string, component_id string"
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, None, None, "s", 0, "q", "k", "l", "n", "c"), (2, "", "en", None, 0, *"qklnc"), (None, words, "en", "s", 1, *"qklnc"), (3, words, "en", "s", 1, *"qklnc"), (3, "x " * 50_000, "en", "s", 1, *"qklnc")]
    for name, part in (("empty", []), ("odd", rows)):
        base = f"{tmp_path}/{name}"
        spark.createDataFrame(part, schema).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{base}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
        docs = spark.read.parquet(f"{base}/documents.parquet")
        for k, (_, stage) in enumerate(cp.STAGES):
            columns = docs.columns
            stage(spark, docs, base).write.parquet(f"{base}/{k}")
            docs = spark.read.parquet(f"{base}/{k}")
            assert k == 3 or docs.columns == columns
        got = docs.collect()
        assert (got == []) if name == "empty" else len({(r.doc_id, r.piece) for r in got if r.piece == 0}) == 3
