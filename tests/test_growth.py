"""What keeps the cost of queries in proportion to their input: exchanges, scans, sorts, and what is computed once."""

import re
from pathlib import Path

import pytest

from quarryline.plans.catalogue import QUERIES

SF = str(Path("/root/testdata/sf0.001"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(df, pattern):
    return len(re.findall(pattern, plan(df)))


@pytest.mark.parametrize("name", ["task_features", "diff_hunk_counting", "diff_old_files", "patch_findings"])
def test_patches_are_built_by_one_exchange(spark, name):
    df = QUERIES[name](spark, SF)
    assert counted(df, r"Exchange hashpartitioning\(l_orderkey") == 1
    assert counted(df, r"FileScan parquet \[l_orderkey") == 1
    assert not re.search(r"Exchange hashpartitioning\((l_orderkey\S*, p_brand|id)", plan(df))


def test_ranks_list_no_pairs(spark):
    from pyspark.sql import functions as F

    from quarryline.operators import neighbours

    assert not re.search("NestedLoop|CartesianProduct", plan(QUERIES["agg_mrr_hitk"](spark, SF)))
    vecs = {0: ([1.0, 0.0], 1), 1: ([1.0, 0.0], 2), 2: ([2.0, 0.0], 1), 3: ([0.0, 1.0], 3), 4: (None, 3), 5: ([-1.0, 0.0], 4), 6: ([1.0, None], None)}
    df = spark.createDataFrame([(k, v, label) for k, (v, label) in vecs.items()], "id long, vec array<float>, label int")
    got = {r.key: r.rank for r in neighbours.label_ranks(df, "id", "vec", "label", F.lit(True)).collect()}
    assert got == {0: 2, 1: None, 2: 1 + 1 - 1, 3: 5, 4: 4, 5: None, 6: None}


def test_reports_are_read_once(spark):
    from quarryline.sources import readers

    xml = "<r><testsuite tests='3' failures='1'/><testsuite tests='2.5' errors='x'/></r>"
    df = readers.junit_counts(spark.createDataFrame([(1, xml), (2, "<testsuite tests='9999999999' skipped='2'/>"), (3, ""), (4, None)], "id int, x string"), "x")
    assert [tuple(r)[2:] for r in df.orderBy("id").collect()] == [(5, 1, 0, 0, 4), (2147483647, 0, 0, 2, 2147483645), (0, 0, 0, 0, 0), (0, 0, 0, 0, 0)]
    assert len({x for x in re.findall(r"(?i)xpath\w*", plan(df))}) <= 1 and not re.search("(?i)xpath_?int", plan(df))


def test_yaml_is_parsed_once_and_in_many_tasks(spark):
    from quarryline.sources import readers

    assert "Exchange hashpartitioning" in plan(QUERIES["src_yaml"](spark, SF))
    assert not re.search("ArrowEvalPython.*yaml_facts", plan(QUERIES["bundle_findings"](spark, SF)))
    assert readers.yaml_readers(None) is readers.yaml_readers(None)
    assert readers.loaded("a: !x b\nc: [1, 2.5, null, yes]") == {"a": "b", "c": [1, 2.5, None, True]}
    with pytest.raises(Exception, match="unclosed|expected"):
        readers.loaded("key: [unclosed")


LINE_QUERIES = ["diff_files", "diff_read_range", "diff_hunks", "win_diff_segments", "diff_parse_hunks", "agg_hunk_lines"]


@pytest.mark.parametrize("name", LINE_QUERIES)
def test_lines_of_patches_are_no_sorted_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert not re.search(r"Window|Exchange hashpartitioning\((?!l_orderkey|l_partkey|p_partkey)", plan(df))


def test_pieces_of_odd_diffs_are_those_of_the_sql(spark):
    """The operators against the windows of the SQL text, on lines in any order."""
    import random

    from quarryline.operators import diffs
    from quarryline.plans import texts
    from quarryline.plans.dialect import SPARK

    draw = random.Random(3)
    some = ["diff --git a/x.py b/x.py", "diff --git odd", "--- a/x.py", "+++ b/x.py", "@@ -31,2 +1,2 @@", "@@ -5,20 +2 @@ def f", " a", "+b", "-c", "", "+++", "---", "index 1", "\\ none"]
    rows = [(k, "\n".join(draw.choice(some) for _ in range(draw.randint(0, 24)))) for k in range(400)] + [(400, ""), (401, None)]
    rows = spark.createDataFrame(rows, "id long, patch string")
    rows.createOrReplaceTempView("odd_patches")
    made = {"diff_files": diffs.file_counts, "diff_hunks": diffs.hunk_texts, "win_diff_segments": diffs.hunk_sizes, "diff_read_range": diffs.read_ranges}
    for name, operator in made.items():
        text = re.sub(r"(\d)D\b", r"\1e0", texts.QUERIES[name](SPARK)).replace(texts.patches(SPARK), "patches AS (SELECT id, patch FROM odd_patches)")
        want = spark.sql(text)
        got = operator(rows, "id", "patch").select(want.columns)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect()))), name


def test_edges_are_normalised_once(spark):
    df = QUERIES["graph_edges"](spark, SF)
    assert counted(df, "FileScan parquet") == 1 and counted(df, r"Exchange hashpartitioning\(graph") == 2


def test_compaction_sorts_turns_by_one_order(spark):
    df = QUERIES["win_compaction"](spark, SF)
    assert counted(df, r"Sort \[") == 2  # the query's own row numbers, and the turns
