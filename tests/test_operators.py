import io
import json
import os
import zipfile
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.functions import stats, text
from quarryline.operators import configs, diffs, evaluation, folds, inspection, retrieval, trajectories
from quarryline.plans import agents, catalogue
from quarryline.sources import readers, sinks
from quarryline.streaming import telemetry

SF = "/root/testdata/sf0.001"
DIFF = "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1,2 +1,2 @@\n-old\n+new\n same\n@@ -9 +9,2 @@\n keep\n+more\n\\ No newline at end of file\n"
GONE = "diff --git a/y.py b/y.py\ndeleted file mode 100644\n--- a/y.py\n+++ /dev/null\n@@ -1 +0,0 @@\n--- x\n"


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("value", ["", "a", "a\n", "a\n\nb", "a\r\nb\rc", "a\x0bb\x1cc d\x85", "\n", "x\n\n"])
def test_splitlines(spark, value):
    assert one(spark, value, text.splitlines) == value.splitlines()


def test_text_predicates(spark):
    assert [one(spark, p, text.is_test_path) for p in ("src/latest/a.py", "a.py", "Tests/x")] == [True, False, True]
    assert [one(spark, p, text.is_protected_path) for p in ("tests/a.py", "a_test.py", "src/latest/a.py", "x/setup.cfg")] == [True, True, False, True]
    assert [one(spark, p, text.is_scratch_path) for p in ("repro.py", "/tmp/repro.py", "x.py")] == [True, False, False]
    assert one(spark, "The parser fails when parser reads", text.keywords) == "parser, fails, when"
    assert one(spark, "no", text.keywords) == "issue"
    assert one(spark, "parseHTMLPage_v2", text.sub_tokens) == ["parse", "html", "page", "v", "2"]


@pytest.mark.parametrize(("files", "lines", "tier"), [(1, 19, "SIMPLE"), (1, 20, "MODERATE"), (3, 100, "MODERATE"), (3, 101, "COMPLEX"), (4, 1, "COMPLEX"), (2, 5, "MODERATE")])
def test_tiers(spark, files, lines, tier):
    assert spark.range(1).select(diffs.tier(F.lit(files), F.lit(lines)).alias("t")).first().t == tier


def test_diff_parsers(spark):
    df = spark.createDataFrame([(1, DIFF + GONE), (2, ""), (3, "--- a/z.py\n+++ b/z.py\n@@ -1 +1 @@ def foo():\n-a\n+class B:"), (4, None), (5, DIFF.replace("+1,2", "+1,9"))], "id long, patch string")
    got = [tuple(r) for r in diffs.parse_hunks(df.where("id < 5"), "id", "patch").orderBy("id", "file_no", "hunk_no").collect()]
    assert got == [
        (1, 1, "x.py", 1, 1, 2, 1, 2, ["old", "same"], ["new", "same"]),
        (1, 1, "x.py", 2, 9, 1, 9, 2, ["keep"], ["keep", "more"]),
        (1, 2, "y.py", 1, 1, 1, 0, 0, ["-- x"], []),
    ]
    counted = {r.id: r for r in diffs.parse_counted(df, "id", "patch").collect()}
    assert [len(counted[k].files) for k in range(1, 6)] == [2, 0, 1, 0, 1]
    x, y = counted[1].files
    assert (x.path, x.added, x.deleted, x.hunks, y.path, y.deleted, y.status) == ("x.py", 2, 1, 2, "y.py", 1, "deleted")
    z = counted[3].files[0]
    assert (z.path, z.symbols, z.status, z.added) == ("z.py", ["B", "foo"], "modified", 1)
    assert (counted[1].malformed, counted[1].unterminated, counted[5].malformed) == (0, False, 1)
    assert one(spark, DIFF + GONE, diffs.changed_files) == 2 and one(spark, "--- a\n--- /dev/null\n", diffs.changed_files) == 1
    assert one(spark, DIFF, diffs.changed_lines) == 3 and one(spark, DIFF, diffs.old_files) == ["x.py"]
    added = "diff --git a/n b/n\n--- /dev/null\n+++ b/tmp_x.py\n@@ -0,0 +1 @@\n+x\ndiff --git a/t b/t\n--- a/tests/t.py\n+++ b/tests/t.py\n@@ -1 +1,5 @@\n+y\n"
    rows = spark.createDataFrame([(1, added), (2, " "), (3, "no diff")], "id long, patch string")
    found = {r.id: [m.message.split(":")[0] for m in r.findings] for r in diffs.findings(diffs.parse_counted(rows, "id", "patch").join(rows, "id"), F.col("patch"), 1).collect()}
    assert found == {1: ["hunk line counts do not match the @@ headers (corrupted diff)", "modifies a test file", "looks like a leftover scratch file", "very large patch (2 changed lines)"], 2: ["empty patch"], 3: ["no file headers found"]}
    f = diffs.features(diffs.parse_counted(rows, "id", "patch")).where("id = 1").first()
    assert (f.gold_files, f.n_files, f.churn, f.adds_new_file, f.patch_ok) == (["tmp_x.py"], 2, 2, True, False)


def test_edits():
    assert diffs.apply_edit("a = 1\nb = 2", "b = 2", "b = 3") == ("a = 1\nb = 3", "exact")
    assert diffs.apply_edit("x  =\n1", "x = 1", "y") == ("y", "spaces")
    assert diffs.apply_edit("f( x,y )", "f(x, y)", "g") == ("g", "tokens")
    assert diffs.apply_edit("a a", "a", "b")[1] == "ambiguous" and diffs.apply_edit("a", "z", "b")[1] == "missing"


def test_folds(spark):
    df = spark.createDataFrame([(g,) for g, n in zip("abcde", (9, 5, 4, 3, 1), strict=True) for _ in range(n)], "g string")
    assert dict(folds.modulo_folds(df, "g", 4).collect()) == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 0}
    assert dict(folds.balanced_folds(df, "g", 2).collect()) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    with pytest.raises(ValueError):
        folds.modulo_folds(df.where("g = 'a'"), "g", 4)
    whole = folds.complement(folds.modulo_folds(df, "g", 4))
    assert whole.where("validates").count() == 5 and whole.count() == 20
    train, val = folds.split(folds.with_fold(df, folds.modulo_folds(df, "g", 4), "g"), 0)
    assert (train.count(), val.count()) == (12, 10)


def test_statistics(spark):
    p = lambda *x: spark.range(1).select(stats.is_significant(*map(F.lit, x)).alias("s"), stats.permutation_p(*map(F.lit, x)).alias("p")).first()
    assert p(25, 25, 0, 25).s and not p(9, 20, 9, 20).s and not p(0, 0, 0, 0).s
    assert p(12, 20, 6, 20).p == pytest.approx(0.0555, abs=1e-3)
    got = spark.createDataFrame([([0.1, 0.105, 0.108, 0.1, 0.1, 0.1, 0.9],)], "v array<double>").select(stats.early_stop(F.col("v"), 0.01, 5).alias("s")).first().s
    assert (got.best, got.since, got.stopped_at) == (0.1, 5, 5)


def test_significance_of_large_samples(spark):
    p = lambda *x: spark.range(1).select(stats.is_significant(*map(F.lit, x)).alias("s"), stats.permutation_p(*map(F.lit, x)).alias("p")).first()
    small = p(50_200, 100_000, 50_000, 100_000)  # products beyond 2^31
    assert not small.s and small.p == pytest.approx(0.1868, abs=1e-3)
    assert p(51_000, 100_000, 50_000, 100_000).s
    large = p(2_000_000_000, 4_000_000_000, 1_999_000_000, 4_000_000_000)  # samples beyond 2^31
    assert large.s and large.p < 1e-6
    assert p(30, 100, 60, 100).p == pytest.approx(1.0, abs=1e-4) and p(0, 10, 5, 10).p == pytest.approx(1.0)


def test_items_in_long_texts_are_found_in_one_reading(spark):
    import time

    from quarryline.operators import inspection

    long = "a  b 🙂 c\nd " * 60_000  # 360,000 parts
    texts = spark.createDataFrame([(1, long + "x  y z w v"), (2, " lead  two three four five "), (3, "a b"), (4, None), (5, "x  y z w")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "x  y z w v"), (2, " lead  two three"), (3, "b 🙂 c\nd a  b"), (4, "two three four five "), (5, "q  y z w v")], "item_id long, text string")
    start = time.monotonic()
    assert sorted(map(tuple, inspection.verbatim(texts, items).collect())) == [(1, 1), (1, 3), (2, 2), (2, 4)]
    assert time.monotonic() - start < 120


def test_json_strings_are_those_of_the_standard_library(spark):
    for v in ["", "a", 'q"\\', "é🙂\u2028", "\t\n\r\b\f\x01\x7f", "tab\tand é"]:
        assert one(spark, v, text.json_string) == json.dumps(v)


def test_text_of_turns(spark):
    t = trajectories
    turns = F.array(
        t.turn("user", text=" Do it. "), t.turn("model", " think ", "say\n", "read_file", {"filepath": "a/é.py", "start_line": F.lit(3)}), t.turn("user", result=" done "), t.turn("model"),
    )
    row = spark.range(1).select(turns.alias("turns")).select(t.formatted(F.col("turns")).alias("f"), t.turn_tokens(F.col("turns")).alias("n"), t.formatted(F.slice("turns", 1, 0)).alias("none")).first()
    call = json.dumps({"tool_name": "read_file", "args": {"filepath": "a/é.py", "start_line": 3}})
    want = f"<bos><|turn>user\nDo it.\n<turn|>\n<|turn>model\n<|channel>thought\nthink\n<channel|>\nsay\n<|tool_call>\n{call}\n<tool_call|>\n<turn|>\n<|turn>user\ndone\n<turn|>\n<|turn>model\n<turn|>\n"
    assert row.f == want and row.none == "<bos>"
    parts = ["user  Do it.  ", f"model  think  say\n  read_file {json.dumps({'filepath': 'a/é.py', 'start_line': 3})}", "user    done ", "model   "]
    assert row.n == sum(-(-len(p) // 4) for p in parts)


def test_trajectories(spark):
    tasks = agents.task_rows(spark, SF)
    made = trajectories.validated(trajectories.synthesise(tasks)).cache()
    assert made.where("exists(errors, e -> e not like 'edit_file missing old_string%') or size(warnings) > 0").count() == 0  # pure additions have no old text to edit
    row = made.where("size(files) > 1").orderBy("instance_id").first()
    n = len(row.turns)
    assert n == 1 + 4 + 2 * len(row.files) + 1 + 2 * sum(len(f.hunks) for f in row.files) + 2 + 2
    assert row.turns[0].text.startswith("You are evaluating a software engineering task for repository ") and row.turns[0].text.endswith("150 lines per read_file call\n")
    assert json.loads(row.turns[2].tool_result)["results"][0] == {"node_name": "add_numbers", "filepath": "utils.py", "score": 0.95}
    more = {r.strategy: r.turns for r in trajectories.augment(made.drop("errors", "warnings", "valid"), count=6).where(F.col("instance_id") == row.instance_id).collect()}
    grown = {"swap_navigation": n, "failed_edit": n + 3, "wider_reads": n, "grep_first": n, "scratch_block": n + 6, "budget_checks": n + 4}
    assert {k: len(v) for k, v in more.items()} == grown
    tool = lambda t: t.tool_calls[0].tool_name if t.tool_calls else None
    assert [tool(t) for t in more["swap_navigation"][1:5:2]] == ["get_code_neighbors", "search_similar_code"]
    assert tool(more["grep_first"][1]) == "run_command" and "grep -rn 'add_numbers' ." in more["grep_first"][1].tool_calls[0].args["command"] and "def foo" in more["grep_first"][2].tool_result
    k = next(i for i, t in enumerate(row.turns) if tool(t) == "edit_file")
    assert more["failed_edit"][k].tool_calls[0].args["old_string"].startswith("INVALID") and more["failed_edit"][k + 3] == row.turns[k]
    read = next(i for i, t in enumerate(row.turns) if tool(t) == "read_file")
    a, b = (x[read].tool_calls[0].args for x in (row.turns, more["wider_reads"]))
    assert (int(b["start_line"]), int(b["end_line"])) == (max(1, int(a["start_line"]) - 10), int(a["end_line"]) + 10)
    assert [tool(more["budget_checks"][i]) for i in (n // 3, 2 * n // 3 + 2)] == ["get_status"] * 2


def test_symbols_and_long_hunks(spark):
    hunk = lambda o, n: F.struct(F.lit(1).alias("old_start"), F.lit(1).alias("old_count"), F.lit(o).alias("old_text"), F.lit(n).alias("new_text"))
    files = lambda *h: F.array(F.struct(F.lit("p").alias("path"), F.array(*h).alias("hunks")))
    s = lambda f, k=None: spark.range(1).select(trajectories.symbols(f, k).alias("s")).first().s
    assert s(files(hunk("def a(x):", "class B:\n  def a(y)\nasync def c():"))) == ["a", "B"]
    assert s(files(hunk("x", "y")), F.array(F.lit("g"))) == ["g"] and s(files(hunk("x", "y"))) == ["add_numbers"]
    cut = lambda a, b: spark.range(1).select(trajectories.cut_hunk(F.transform(F.sequence(F.lit(1), F.lit(a)), lambda x: x.cast("string")), F.transform(F.sequence(F.lit(1), F.lit(b)), lambda x: x.cast("string"))).alias("c")).first().c
    assert len(cut(15, 20).new_text.split("\n")) == 20 and len(cut(16, 20).new_text.split("\n")) == 15 and len(cut(16, 20).old_text.split("\n")) == 15


def test_bad_trajectories_and_rewards(spark):
    t = trajectories
    bad = F.array(t.turn("model", tool="edit_file", args={"filepath": "tests/a.py", "old_string": ""}), t.turn("model", tool="write_file", args={"filepath": "scratch.py"}))
    df = spark.range(1).select(bad.alias("turns"), F.lit(32000).alias("token_count"), F.lit(81).alias("num_tool_calls"), F.lit("p").alias("patch"), F.lit(1).alias("passed"), F.lit(2).alias("total"), F.lit("SIMPLE").alias("complexity"), F.lit(True).alias("had_truncation"))
    got = t.validated(df).first()
    assert got.errors == ["Token count 32000 exceeds 28672", "edit_file missing old_string for tests/a.py", "Modifies test file: tests/a.py", "Scratch file in workspace: scratch.py"]
    assert got.warnings == ["Tool calls 81 exceeds recommended 80", "submit_patch is not the last tool call"] and not got.valid
    assert df.select(t.reward(df).alias("r")).first().r == pytest.approx(max(-1.5, 0.25 + 0.15 - 0.2 - 0.3 - 0.5 - 0.4))
    scored = spark.createDataFrame([("a", i, s) for i, s in enumerate([0.9, 0.5, 0.61])], "instance_id string, gen int, score double")
    assert {(r.chosen, r.rejected) for r in t.preference_pairs(scored).collect()} == {(0, 1)}


def test_inspection(spark):
    cells = spark.createDataFrame([("n", 0, "use GOLD_PATCH"), ("n", 1, "x = manual_patches"), ("m", 0, "num_epochs = 1"), ("k", 0, "instance_id"), ("c", 0, "ok")], "path string, index int, source string")
    assert {r.path: r.risk_level for r in inspection.inspect(cells).collect()} == {"n": "critical", "m": "medium", "k": "low", "c": "clean"}
    assert inspection.scan(cells).count() == 4
    cases = [(0.06, 0.05, True, "low", 3, 0, "ADOPT"), (0.06, 0.05, True, "critical", 3, 1, "REJECT"), (0.03, 0.15, True, "medium", 1, 1, "PARTIAL_ADOPT"), (0.3, 0.21, True, "clean", 4, 1, "REJECT"), (0.03, 0.0, False, "clean", 4, 1, "REJECT")]
    df = spark.createDataFrame(cases, "i double, g double, s boolean, r string, n int, b int, want string")
    assert all(r.want == r.d for r in df.withColumn("d", inspection.decision(*(F.col(c) for c in "igsrnb"))).collect())
    files = spark.createDataFrame([("a", "agent.yaml", 5, False, "model: x\n"), ("a", "x.bin", 5, False, None)], "bundle string, path string, length long, is_link boolean, content string")
    with pytest.raises(ValueError, match="extensions"):
        inspection.gate(inspection.bundle_checks(files))
    whole = [("b", "adapter_config.json", 5), ("b", "w.safetensors", 9), ("c", "w.safetensors", 9), ("d", "adapter_config.json", 1), ("d", "w.safetensors", 1), ("d", "x.pt", 1)]
    assert dict(inspection.checkpoint_complete(spark.createDataFrame(whole, "bundle string, path string, length long")).collect()) == {"b": True, "c": False, "d": False}


def test_evaluation_of_nothing(spark):
    none = spark.createDataFrame([], "ord long, repo string, fold long, resolved boolean, complexity string, tokens long, num_tool_calls long, had_truncation boolean")
    assert evaluation.fold_results(none).collect() == [] and evaluation.subset_result(none).first().resolution_rate == 0.0
    assert evaluation.report(none).first().recommendations[0].startswith("CRITICAL: Resolution rate")


def test_artifacts(spark):
    tasks = spark.createDataFrame([("t1", "0123456789abcdef", "own/repo"), ("task_2", "", "a/b"), ("none", "", "zz/yyyy")], "instance_id string, base_commit string, repo string")
    files = spark.createDataFrame([("x/own__repo.json",), ("x/0123456/long.json",), ("x/0123456.json",), ("task_2.zip",), ("repo",)], "path string")
    assert dict(retrieval.artifact_matches(tasks, files).collect()) == {"t1": "x/0123456.json", "task_2": "task_2.zip"}


def test_sources(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"instance_id": "a", "more": 1, "patch": null}\n\n  \n{"repo": "o/r"}\n')
    assert [r.instance_id for r in readers.tasks(spark, f"{tmp_path}/t.jsonl").collect()] == ["a", ""]
    assert readers.tasks(spark, f"{tmp_path}/none.jsonl").count() == 0
    (tmp_path / "g").mkdir()
    (tmp_path / "g/one.json").write_text(json.dumps({"nodes": [{"id": "x", "name": "f"}], "links": [{"src": "x", "target": "y", "type": "calls"}]}))
    nodes, edges = readers.graphs(spark, f"{tmp_path}/g")
    assert nodes.first().graph_id == "one" and edges.first().source == "x"
    (tmp_path / "v").mkdir()
    np.savez(tmp_path / "v/e.npz", a=np.ones(4, np.float32))
    (tmp_path / "v/bad.npz").write_bytes(b"no")
    assert [(r.graph_id, r.node_id, r.vec) for r in readers.vectors(spark, f"{tmp_path}/v").collect()] == [("e", "a", [1.0] * 4)]
    (tmp_path / "n.ipynb").write_text(json.dumps({"cells": [{"cell_type": "code", "source": ["a\n", "b"]}, {"cell_type": "markdown", "source": "c"}]}, indent=1))
    assert [(r["index"], r.cell_type, r.source) for r in readers.notebook_cells(spark, f"{tmp_path}/n.ipynb").collect()] == [(0, "code", "a\nb"), (1, "markdown", "c")]
    xml = spark.createDataFrame([('<testsuite tests="5" failures="1" errors="1" skipped="0"/>',), ("broken <",), (None,)], "x string")
    assert [r.passed for r in readers.junit_counts(xml, "x").collect()] == [3, 0, 0]
    (tmp_path / "z").mkdir()
    data, digest = sinks.fixed_zip({"b.py": b"2", "a.py": b"1", "c.txt": b"3"})
    assert sinks.fixed_zip({"a.py": b"1", "c.txt": b"3", "b.py": b"2"}) == (data, digest) and zipfile.is_zipfile(io.BytesIO(data))
    (tmp_path / "z/a.zip").write_bytes(data)
    assert {r.name for r in readers.archive_texts(spark, f"{tmp_path}/z").collect()} == {"a.py", "b.py"}
    assert readers.inventory(spark, f"{tmp_path}/z").first().length == len(data)
    assert readers.settings('{"a": {"b": 1}}', {"Q_A__B": "2.5", "Q_C": "true", "X": "1"}, "Q_") == {"a": {"b": 2.5}, "c": True}
    assert readers.section({"x": {"y": 1}}, "x") == {"y": 1} and readers.section({"y": 1}, "x") == {"y": 1}


def test_more_sources(spark, tmp_path):
    (tmp_path / "r.yaml").write_text("solutions:\n- {name: a, lb_score: null, status: done, key_techniques: [x, 1]}\n- {notebook_name: b, lb_score: 0.5, leak_detected: false, prompt_strategy: p}\n- text\n")
    rows = readers.registry(spark, f"{tmp_path}/r.yaml").collect()
    assert [(r.notebook_name, r.lb_score, r.analysis_status, r.key_techniques, r.leak_detected, r.prompt_strategy) for r in rows] == [("a", 0.0, "done", ["x", "1"], None, None), ("b", 0.5, "pending", [], False, "p")]
    assert readers.registry(spark, f"{tmp_path}/none.yaml").count() == 0
    (tmp_path / "j.json").write_text('{"a": 1}')
    (tmp_path / "bad.json").write_text("{")
    assert readers.json_object(spark, f"{tmp_path}/j.json") == {"a": 1} and readers.json_object(spark, f"{tmp_path}/bad.json") == {} == readers.json_object(spark, f"{tmp_path}/none.json")
    with pytest.raises(FileNotFoundError):
        readers.read_text(spark, f"{tmp_path}/none")
    leaves = readers.yaml_leaves(spark.createDataFrame([(1, "a: {b: [1, !include x.md]}"), (2, "a: ["), (3, None)], "k long, t string"), "k", "t").collect()
    assert [(r.k, r.path, r.value, r.error is None) for r in leaves] == [(1, "/a/b/0", "1", True), (1, "/a/b/1", "x.md", True), (2, None, None, False), (3, "", None, True)]
    assert readers.flattened({"cv": {"k": 4}, "x": 1}) == {"cv": {"k": 4}, "k": 4, "x": 1}
    assert readers.settings("a:\n  b: 1\n", {"Q_A__B": "no"}, "Q_") == {"a": {"b": "no"}}
    tasks = readers.mock_tasks(spark, 4)
    assert tasks.select("repo").distinct().count() == 4 and tasks.select(diffs.changed_lines(F.col("patch")).alias("n")).first().n == 2
    nodes, edges, vectors = readers.mock_graph(spark)
    assert nodes.first().name == "add_numbers" and edges.count() == 0 and len(vectors.first().vec) == 256
    (tmp_path / "t.jsonl").write_text('{"instance_id": "fast_api_12", "created_at": "2024-05-06T01:02:03Z"}\n{"instance_id": "x", "created_at": "soon"}\n')
    described = readers.described_tasks(spark, f"{tmp_path}/t.jsonl").collect()
    assert [(r.repo, r.created_ts is None) for r in described] == [("fast_api", False), ("x", True)]
    (tmp_path / "f.csv").write_text("name,size\na.py,3\n")
    assert tuple(readers.listing(spark, f"{tmp_path}/f.csv").first()) == ("a.py", 3)
    for name, content in (("d/a.py", b"x"), ("d/b.PY", b"yy"), ("d/e/c.py", b"zzz"), ("d/e/f/g.py", b"far"), ("d/t.md", b"caf\xc3\xa9")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    files = readers.inventory(spark, f"{tmp_path}/d")
    assert {(r.ext, r.n) for r in readers.by_extension(files, f"{tmp_path}/d", 1).collect()} == {(".py", 2), (".PY", 1), (".md", 1)}
    assert sorted(r.text for r in readers.texts(spark, f"{tmp_path}/d", [".py", ".md"], 2).collect()) == ["x", "yy"] and readers.texts(spark, f"{tmp_path}/d", [".md"]).first().text == "café"
    np.save(tmp_path / "v.npy", np.eye(2, dtype=np.float32))
    assert [r.vec for r in readers.any_table(spark, f"{tmp_path}/v.npy").orderBy("row").collect()] == [[1.0, 0.0], [0.0, 1.0]]
    assert readers.any_table(spark, f"{tmp_path}/t.jsonl").count() == 2
    with pytest.raises(ValueError, match="no reader"):
        readers.any_table(spark, "x.pickle")
    docs = spark.createDataFrame([(1, "max_model_len 4096\nnone\nMax model len: 1\n\nmax-model-len\nmax_model_len again")], "k long, t string")
    assert [r.line_no for r in readers.facts(docs, "k", "t", {"limit": "max[ _-]model[ _-]len"}).orderBy("line_no").collect()] == [0, 2, 4]
    assert one(spark, "p: !include a.md\nq: !include ../b", lambda c: readers.included(c, {"a.md": "$1 text", "../b": "no"})) == "p: $1 text\nq: !include ../b"


def test_more_sinks(spark, tmp_path):
    events = spark.range(1).select(*sinks.telemetry_event("metric", "v1", F.struct(F.lit(0.5).alias("score")), F.lit("2024-01-02 03:04:05").cast("timestamp")))
    assert tuple(events.first()) == ("2024-01-02T03:04:05Z", "v1", "metric", '{"score":0.5}')
    with pytest.raises(ValueError, match="telemetry"):
        sinks.telemetry_event("other", "v1", F.struct(F.lit(1).alias("x")))
    assert sinks.config_json({"b": 1, "a": type("C", (), {"__init__": lambda self: self.__dict__.update(x=1, _y=2)})()}) == '{"a": {"x": 1}, "b": 1}'
    results = spark.createDataFrame([("a", True, "diff", "log"), ("b", False, None, "log2")], "instance_id string, resolved boolean, patch string, trace string")
    sinks.write_results(results, folders=True, path=f"{tmp_path}/r")
    assert spark.read.json(f"{tmp_path}/r/summary").first().resolution_rate == 0.5 and spark.read.json(f"{tmp_path}/r/task_results").count() == 2
    assert spark.read.text(f"{tmp_path}/r/patches").first().instance_id == "a" and spark.read.text(f"{tmp_path}/r/traces").count() == 2
    assert sinks.released("v1.2.3", "minor", "# Log\n", "more", "2024-01-02") == ("1.3.0", "# Log\n\n## [v1.3.0] - 2024-01-02\n- more\n")
    registry = spark.createDataFrame([("n", "pending")], "name string, status string")
    twice = spark.createDataFrame([("n", "done"), ("n", "also")], "name string, status string")
    assert [r.status for r in sinks.update_registry(registry, twice, "name").collect()] == ["done"] and sinks.append_registry(registry, twice.drop("status")).count() == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", " "), ("b", "diff")], "id string, prediction string")
    sinks.write_submission(df, f"{tmp_path}/s")
    assert {r.id: r.prediction for r in spark.read.parquet(f"{tmp_path}/s").collect()} == {"a": "NO_PATCH", "b": "diff"}
    registry = spark.createDataFrame([("n", "pending", 1), ("n", "x", 2), ("m", "y", 3)], "name string, status string, k int")
    new = sinks.update_registry(registry, spark.createDataFrame([("n", "done")], "name string, status string"), "name")
    assert sorted(map(tuple, new.collect())) == [("m", "y", 3), ("n", "done", 1), ("n", "done", 2)]
    sinks.append_telemetry(df, f"{tmp_path}/t")
    sinks.append_telemetry(df, f"{tmp_path}/t")
    assert spark.read.json(f"{tmp_path}/t").count() == 4
    assert json.loads(sinks.history_json(df, "id").first().json) == [{"id": "a", "prediction": " "}, {"id": "b", "prediction": "diff"}]


def test_streams(spark):
    events = telemetry.read_events(spark, f"{SF}/events*.parquet")
    status = telemetry.drained(telemetry.budget_status(events, most=30), "update").collect()
    want = spark.read.parquet(f"{SF}/events.parquet").where("event_type <> 'signup'").groupBy("user_id").count().collect()
    assert {r.user_id: r.used for r in status if r.used} == {r.user_id: r["count"] for r in want}
    gaps = telemetry.gap_alerts(spark.createDataFrame([(0.5, 0.34), (0.5, 0.3), (0.5, None)], "cv_score double, lb_score double"))
    assert gaps.count() == 2


def test_streams_of_several_batches(spark, tmp_path):
    """Late events are left out, early stopping and timeouts remember earlier batches."""

    def put(name, rows, schema):
        seen = set(tmp_path.glob(f"{name}/part-*"))
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        for f in set(tmp_path.glob(f"{name}/part-*")) - seen:  # files are read in order of their times
            os.utime(f, (10**9 + 10 * len(seen), 10**9 + 10 * len(seen)))

    event = lambda k, at, user=1: (k, datetime.fromisoformat(f"2024-01-01T{at}"), user, "click", 1.0, "{}")
    for k, at in enumerate(("10:00:00", "12:00:00", "12:01:00", "10:05:00", "15:00:00")):
        put("e", [event(k, at, 2 if k == 4 else 1)], telemetry.EVENT)
    stream = spark.readStream.schema(telemetry.EVENT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/e")
    rows = telemetry.drained(telemetry.windowed_counts(stream), "append").collect()
    assert {r.start.hour: r.n for r in rows} == {10: 1, 12: 2}  # 10:05 came too late, 15:00 may still grow
    ended = [r.user_id for r in telemetry.drained(telemetry.timeouts(stream), "update").where("ended").collect()]
    assert 1 in ended
    for k, v in enumerate([0.1, 0.105, 0.1, 0.2, 0.2, 0.2, 0.2, 0.9]):
        put("m", [(1, k, v)], "run long, step long, value double")
    metrics = spark.readStream.schema("run long, step long, value double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/m")
    last = telemetry.drained(telemetry.stops(metrics, 0.01, 3), "update").where("stopped").first()
    assert (last.best, last.waited) == (0.2, 3)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES.keys() - catalogue.ORACLE.keys()))
def test_queries_without_sql_run(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_yaml_that_cannot_be_read_fails(spark):
    files = [
        ("a", "agent.yaml", "model: m\ngenerate_content_config:\n  max_output_tokens: 100\n"), ("b", "agent.yaml", "model: m\nkey: [unclosed list"), ("c", "agent.yaml", "model: m\ngenerate_content_config: 3\n"),
        ("d", "agent.yaml", "model: m\n"), ("d", "sub/x.yml", "key: [unclosed list"), ("e", "agent.yaml", "{model: m, generate_content_config: {max_output_tokens: 32768, thinking_config: {thinking_budget: 16385}}}"), ("f", "agent.yaml", "x: !other y"),
    ]
    rows = spark.createDataFrame([(b, p, 5, False, c) for b, p, c in files], "bundle string, path string, length long, is_link boolean, content string")
    failed = {(r.bundle, r.name) for r in inspection.bundle_checks(rows).where("not passed").collect()}
    assert failed == {("b", "yaml_schema"), ("b", "token_limits"), ("b", "single_model"), ("c", "token_limits"), ("d", "yaml_schema"), ("e", "token_limits"), ("f", "yaml_schema"), ("f", "token_limits"), ("f", "single_model")}


def test_findings_on_bundles_by_severity(spark):
    good = [("g", "agent.yaml", 9, "model: m\ntools: [grep]\nprompt: !include prompts/a.md\nsub:\n  - config_path: sub/x.yml\n"), ("g", "sub/x.yml", 9, "model: m"), ("g", "prompts/a.md", 9, "short"), ("g", "adapters/a/w.safetensors", 9, None), ("g", "adapters/a/adapter_config.json", 9, "{}")]
    bad = [("b", "agent.yaml", 9, "model: m\ntools: [odd]\nprompt: !include ../out.md\n"), ("b", "agent.yml", 9, "model: n"), ("b", "p.md", 9, "x" * 20_000), ("b", ".git/x.py", 9, None), ("b", "w.safetensors", 4 << 30, None), ("b", "x.exe", 1, None), ("b", "y.yaml", 1, "a: b: c")]
    rows = spark.createDataFrame(good + bad, "bundle string, path string, length long, content string")
    got = {(r.bundle, r.severity, r["check"], r.detail.split(": ")[0]) for r in configs.bundle_findings(rows, ["grep"]).collect()}
    assert got == {
        ("b", "error", "YAML parses", "y.yaml"), ("b", "error", "allowed file types", "x.exe"), ("b", "warning", "no hidden / cache files", ".git/x.py"), ("b", "error", "exactly one root config", "2"), ("b", "error", "single base model", "2"),
        ("b", "error", "size limit", str((4 << 30) + 38)), ("b", "warning", "prompt size vs context", "5000"), ("b", "error", "references resolve inside the bundle", "agent.yaml → ../out.md"), ("b", "warning", "only verified tools referenced", "odd"),
        ("b", "warning", "adapter config next to weights", "w.safetensors"),
    }
