"""Queries that run the operators over rows shaped like tasks, trajectories, results, notebooks and bundles.

The rows are made from the given tables by SQL that both engines read; what the operators make of them is written a second
time, by hand, as the DuckDB SQL of ORACLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import stats
from quarryline.operators import configs, diffs, evaluation, folds, inspection, trajectories
from quarryline.plans.dialect import SPARK
from quarryline.plans.tasks import RESULTS
from quarryline.plans.texts import patches
from quarryline.session import sql, stored

#: Paths of every kind that the path predicates tell apart.
PATHS = """
    SELECT p_partkey AS id, p_size, CASE p_partkey % 8 WHEN 0 THEN '/tmp/' WHEN 1 THEN 'tests/' WHEN 2 THEN 'src/test_' WHEN 3 THEN 'Scratch/' WHEN 4 THEN 'latest/' WHEN 5 THEN 'pkg/' ELSE '' END
           || replace(p_name, ' ', '_') || CASE p_partkey % 5 WHEN 0 THEN '_test.py' WHEN 1 THEN '/conftest.py' ELSE '.py' END AS path FROM part"""

#: Three calls of each trajectory.
CALLS = f"""
    WITH p AS ({PATHS})
    SELECT id, 1 AS k, 'edit_file' AS tool, path, CASE WHEN id % 7 = 0 THEN '' ELSE 'x' END AS old FROM p
    UNION ALL SELECT id, 2, 'write_file', CASE id % 3 WHEN 0 THEN '/tmp/repro.py' WHEN 1 THEN 'Scratch_' || path ELSE path END, NULL FROM p
    UNION ALL SELECT id, 3, CASE WHEN id % 11 = 0 THEN 'run_command' ELSE 'submit_patch' END, '', NULL FROM p"""

#: What else the trajectories have.
META = """
    SELECT p_partkey AS id, p_size * 1000 AS token_count, p_size * 2 AS num_tool_calls, CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE 'diff' END AS patch, CAST(p_partkey % 4 AS INT) AS passed,
           CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE 3 END AS total, CASE p_partkey % 3 WHEN 0 THEN 'SIMPLE' WHEN 1 THEN 'MODERATE' ELSE 'COMPLEX' END AS complexity, p_partkey % 10 = 0 AS had_truncation FROM part"""

TEST_PATH, SCRATCH_PATH = "'test_|_test[.]py|tests/|test/|conftest[.]py|pytest[.]ini|pyproject[.]toml'", "'repro|scratch|temp|tmp_'"


def as_turn(role, thought=None, text=None, calls=None):
    """A turn from columns."""
    none = F.lit(None).cast("string")
    calls = F.array().cast(f"array<{trajectories.CALL}>") if calls is None else calls
    fields = {"role": role, "thought": none if thought is None else thought, "text": none if text is None else text, "tool_calls": calls, "tool_result": none}
    return F.struct(*(v.alias(k) for k, v in fields.items())).cast(trajectories.TURN)


def trajectory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trajectories of CALLS and META."""
    args = lambda x: F.map_filter(F.create_map(F.lit("filepath"), x["path"], F.lit("old_string"), x["old"]), lambda _, v: v.isNotNull())
    turn = lambda x: as_turn(F.lit("model"), calls=F.array(F.struct(x["tool"].alias("tool_name"), args(x).alias("args"))))
    rows = sql(spark, sf_dir, CALLS).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("k", "tool", "path", "old"))).alias("x"))
    return rows.select("id", F.transform("x", turn).alias("turns")).join(sql(spark, sf_dir, META), "id")


def val_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trajectories.validated(trajectory_rows(spark, sf_dir))
    return rows.select("id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"), "valid")


def reward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trajectory_rows(spark, sf_dir)
    return rows.select("id", F.round(trajectories.reward(rows), 9).alias("reward"))


def pair_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as the plain text of preference pairs; every seventh one has no turns but a patch."""
    rows = sql(spark, sf_dir, "SELECT conv_id, turn, role, CASE WHEN conv_id % 7 = 0 THEN '' ELSE text END AS text, CASE WHEN role = 'assistant' AND conv_id % 7 <> 0 THEN 'step ' || CAST(turn AS STRING) END AS thought FROM conversations")
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "thought", "text"))).alias("x"))
    convs = convs.withColumn("turns", F.transform("x", lambda x: as_turn(x["role"], x["thought"], x["text"])))
    text = trajectories.plain_text(F.col("turns"), F.concat(F.lit("patch "), F.col("conv_id").cast("string")), F.lit(None).cast("string"))
    return convs.select("conv_id", F.sha2(text, 256).alias("text_sha"), trajectories.prompt(F.col("conv_id").cast("string")).alias("prompt"))


#: Raw model outputs in both tag dialects.
RAW = """
    SELECT conv_id, turn, r, CASE WHEN r % 5 = 0 THEN '' WHEN r % 2 = 0 THEN '<|channel>thought think ' || CAST(r AS STRING) || ' <channel|>' ELSE '<|thought|>think ' || CAST(r AS STRING) || '<|/thought|>' END
           || CASE WHEN r % 2 = 0 THEN '<|tool_call>' ELSE '<|tool_call|>' END
           || CASE r % 4 WHEN 0 THEN '{"tool_name": "submit_patch", "args": {"patch": "P' || CAST(r AS STRING) || '"}}' WHEN 1 THEN '{"tool_name": "run_command", "args": {"command": "ls"}}'
                         WHEN 2 THEN '{oops' ELSE '{"tool_name": "grep"}' END
           || CASE WHEN r % 2 = 0 THEN '<tool_call|>' ELSE '<|/tool_call|>' END
           || CASE r % 3 WHEN 0 THEN '<patch> T' || CAST(r AS STRING) || ' </patch>' WHEN 1 THEN 'diff --git a/x b/x' || chr(10) || '+' || CAST(r AS STRING) || chr(10) ELSE '' END AS raw
    FROM (SELECT conv_id, turn, conv_id * 31 + turn AS r FROM conversations) a"""


def rollout_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, RAW)
    tasks = rows.select(F.concat_ws("-", "conv_id", "turn").alias("instance_id"), F.lit("r").alias("repo"), F.lit("p").alias("problem_statement"), "raw")
    made = trajectories.rollout_trajectories(tasks, F.concat("raw", F.when(F.col("gen") == 1, F.lit("")).otherwise(F.lit(" "))), 2)
    told = F.get("turns", F.lit(2))["tool_result"]
    said = F.get("turns", F.lit(1))
    return made.select("instance_id", "gen", said["thought"].alias("thought"), F.array_join(F.transform(said["tool_calls"], lambda c: c["tool_name"]), ",").alias("tools"), told.alias("told"), "patch", "token_count", F.col("num_tool_calls").cast("long").alias("n_calls"), F.col("num_files_changed").cast("long").alias("n_files"))


def task_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of the synthetic diffs: repository, tier, files with hunks."""
    base = f"WITH {patches(SPARK)} SELECT id, patch, c_mktsegment AS repo FROM patches JOIN orders ON id = o_orderkey JOIN customer ON o_custkey = c_custkey"
    rows = sql(spark, sf_dir, base)
    hunks = diffs.parse_hunks(rows, "id", "patch")
    hunk = F.struct("hunk_no", "old_start", "old_count", trajectories.cut_hunk(F.col("old_lines"), F.col("new_lines")).alias("cut"))
    files = hunks.groupBy("id", "file_no", "path").agg(F.sort_array(F.collect_list(hunk)).alias("hunks"))
    flat = lambda h: F.struct(h["old_start"].alias("old_start"), h["old_count"].alias("old_count"), h["cut"]["old_text"].alias("old_text"), h["cut"]["new_text"].alias("new_text"))
    files = files.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("file_no", "path", F.transform("hunks", flat).alias("hunks")))).alias("files"))
    tier = diffs.tier(diffs.changed_files(F.col("patch")), diffs.changed_lines(F.col("patch"))).alias("complexity")
    told = F.concat(F.lit("The parser fails on order "), F.col("id").cast("string")).alias("problem_statement")
    meta = rows.select("id", F.col("id").cast("string").alias("instance_id"), "repo", tier, told, F.lit("").alias("hints_text"))
    return meta.join(files, "id").drop("id")


def train_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set: gold and augmented trajectories of all tasks, valid and within budget, with the folds of their repositories."""
    tasks = task_rows(spark, sf_dir)
    by_repo = folds.modulo_folds(sql(spark, sf_dir, "SELECT c_mktsegment AS repo FROM customer"), "repo", 4)
    rows = trajectories.training_records(tasks, by_repo)
    return rows.select("instance_id", "repo", "complexity", "strategy", F.size("messages").cast("long").alias("n_messages"), F.sha2("formatted_text", 256).alias("text_sha"), F.col("num_tool_calls").cast("long").alias("n_calls"), F.col("num_files_changed").cast("long").alias("n_files"), "fold")


#: Notebooks of five code cells: documents with lines that the scans look for.
CELLS = """
    SELECT 'nb_' || CAST(CAST(floor(doc_id / 5.0D) AS BIGINT) AS STRING) AS path, doc_id AS idx, text || CASE doc_id % 31
        WHEN 1 THEN ' use Test_Patch' WHEN 2 THEN ' agent reads test_patch' WHEN 3 THEN ' x = "fastapi_1" "rich_22" ''httpx_3'' "fastapi_4" "rich_5" "requests_6"' WHEN 4 THEN ' open("/test_a") apply'
        WHEN 5 THEN ' Hardcoded' WHEN 6 THEN ' manual_patches = {}' WHEN 7 THEN ' num_train_epochs = 1' WHEN 8 THEN ' num_epochs: 12' WHEN 9 THEN ' run GRPO' WHEN 10 THEN ' lora train' WHEN 11 THEN ' AgentTool'
        WHEN 12 THEN ' tool_call' WHEN 13 THEN ' total best_of_n' WHEN 14 THEN ' system_prompt = "be good "' WHEN 15 THEN ' Prompt="a" prompt = ''b''' WHEN 16 THEN ' curriculum and pruning' ELSE '' END AS source FROM documents"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, CELLS).withColumnRenamed("idx", "index")


def insp_notebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inspection.inspect(cells(spark, sf_dir))
    return rows.withColumns({"techniques": F.array_join("techniques", ","), "n_prompts": F.size("prompts").cast("long")}).drop("prompts")


def insp_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.scan(cells(spark, sf_dir)).groupBy("check", "finding").agg(F.count("*").alias("n"))


#: Bundles of ten files.
FILES = """
    SELECT bundle, path, length, is_link, CASE path WHEN 'agent.yaml' THEN 'model: m' || CAST(bundle % 3 AS STRING) || chr(10) || CASE bundle % 5 WHEN 0 THEN '' ELSE 'generate_content_config:' || chr(10) ||
               '  max_output_tokens: ' || CAST(32766 + bundle % 4 AS STRING) || chr(10) || '  thinking_config:' || chr(10) || '    thinking_budget: ' || CAST(16384 + bundle % 7 - 5 AS STRING) || chr(10) END
           WHEN 'sub/conf.yml' THEN 'model: m' || CAST(bundle % 2 AS STRING) || chr(10) || CASE WHEN bundle % 13 = 0 THEN 'a: !include ../x' || chr(10) WHEN bundle % 13 = 5 THEN 'key: [unclosed list' || chr(10) WHEN bundle % 13 = 7 THEN 'tools: [grep, odd_tool]' || chr(10) || 'sub: {config_path: ../agent.yaml}' || chr(10) ELSE '' END
           WHEN 'adapters/a1/adapter_config.json' THEN '{"r": ' || CAST(124 + bundle % 6 AS STRING) || '}' WHEN 'adapters/a2/adapter_config.json' THEN '{"lora_rank": ' || CAST(120 + bundle % 11 AS STRING) || '}' END AS content
    FROM (SELECT CAST(floor(p_partkey / 10.0D) AS BIGINT) AS bundle, p_size * 15000000 AS length, p_partkey % 97 = 0 AS is_link, CASE p_partkey % 10 WHEN 0 THEN CASE WHEN p_partkey % 190 = 0 THEN 'agent.md' ELSE 'agent.yaml' END
              WHEN 1 THEN 'adapters/a1/adapter_config.json' WHEN 2 THEN 'adapters/a1/w.safetensors' WHEN 3 THEN 'adapters/a2/adapter_config.json' WHEN 4 THEN CASE WHEN p_partkey % 3 = 0 THEN 'adapters/a2/x.BIN' ELSE 'adapters/a2/w.safetensors' END
              WHEN 5 THEN 'adapters/.cache/x' WHEN 6 THEN 'sub/conf.yml' WHEN 7 THEN 'weights.pkl.txt' WHEN 8 THEN CASE WHEN p_partkey % 7 = 0 THEN 'old.pickle' ELSE 'new.md' END ELSE 'adapters/readme.md' END AS path FROM part) a"""


def bundle_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.bundle_checks(sql(spark, sf_dir, FILES))


def bundle_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many findings of each kind the bundles have."""
    found = configs.bundle_findings(sql(spark, sf_dir, FILES), ["grep"])
    return found.groupBy("bundle", "severity", "check").agg(F.count("*").alias("n"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"WITH {RESULTS} SELECT id AS ord, id, repo, fold, resolved, tier AS complexity, tokens, tools AS num_tool_calls, truncated AS had_truncation FROM results"
    return sql(spark, sf_dir, text)


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluation.fold_results(results(spark, sf_dir))
    tiers = [F.col("tiers")[t].alias(f"n_{t.lower()}") for t in evaluation.TIERS]
    return rows.select("fold", "val_repo", "total", "n_resolved", *(F.round(c, 9).alias(c) for c in ("resolution_rate", "avg_tool_calls", "avg_tokens", "truncation_rate")), *tiers)


def cv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluation.report(results(spark, sf_dir))
    return rows.select(*(F.round(c, 9).alias(c) for c in ("resolution_rate", "simple", "moderate", "complex")), "n_folds", F.array_join("recommendations", "|").alias("recommendations"))


def cv_per_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluation.report(results(spark, sf_dir)).select(F.explode("per_repo").alias("val_repo", "rate"))
    return rows.select("val_repo", F.round("rate", 9).alias("rate"))


def cv_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluation.subset_result(results(spark, sf_dir).where("id % 50 = 0"))
    return rows.select("fold", "val_repo", "total", "n_resolved", F.round("resolution_rate", 9).alias("resolution_rate"))


def cv_fold_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = results(spark, sf_dir).withColumnRenamed("id", "instance_id")
    return evaluation.tiers_of_folds(rows.select("instance_id", "complexity"), rows.where("instance_id % 3 = 0").select("instance_id", "fold"))


def cv_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, VERIFIED)
    gated = evaluation.verified(evaluation.budgeted(rows, 80, 40.0))
    return gated.select("id", "patch", "had_truncation", "resolved", "error")


#: Executions with their test counts, some of which are unknown.
VERIFIED = """
    SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN '  ' ELSE 'p' END AS patch, p_size * 2 AS num_tool_calls, p_retailprice / 40.0D AS elapsed_seconds, p_partkey % 9 = 0 AS had_truncation,
           CAST(p_partkey % 2 AS INT) AS exit_code, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_partkey % 5 AS INT) END AS passed, CAST(p_partkey % 7 AS INT) AS failed, CASE WHEN p_partkey % 11 = 0 THEN 1 END AS errors FROM part"""


def peers(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The folds of the even tasks' results and those of the odd tasks'."""
    side = lambda k: evaluation.fold_results(rows.where(F.col("id") % 2 == k)).withColumnRenamed("fold", "fold_idx")
    return side(0), side(1)


def cmp_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inspection.fold_comparison(*peers(results(spark, sf_dir)))
    return rows.select("val_repo", *(F.round(c, 9).alias(c) for c in ("peer", "baseline", "delta")))


def cmp_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision on the even tasks' run against the odd tasks', for three public scores."""
    tasks = stored(results(spark, sf_dir), "results")
    peer, base = (stored(x, "peer") for x in peers(tasks))  # a few folds each
    improving = inspection.fold_comparison(peer, base).agg(F.count_if(F.col("delta") > 0).alias("improving"))
    both = [x.agg((F.sum("n_resolved") / F.sum("total")).alias(f"rate_{k}"), F.sum("n_resolved").alias(f"hits_{k}"), F.sum("total").alias(f"n_{k}")) for k, x in (("a", peer), ("b", base))]
    rates = tasks.groupBy((F.col("id") % 7).alias("technique")).agg(evaluation.share(F.col("resolved")).alias("resolution_rate"))
    whole = tasks.agg(evaluation.share(F.col("resolved")).alias("base"))
    helps = inspection.beneficial_techniques(rates.crossJoin(whole), F.col("base"), 0.001).agg(F.count("*").alias("beneficial"))
    one = both[0].crossJoin(both[1]).crossJoin(improving).crossJoin(helps)  # one row each
    one = one.select("*", F.explode(F.array(F.lit(0.3), F.lit(0.5), F.lit(0.9))).alias("lb"), (F.col("rate_a") - F.col("rate_b")).alias("improvement"))
    gap, sig = F.abs(F.col("rate_a") - F.col("lb")), stats.is_significant(*(F.col(c) for c in ("hits_a", "n_a", "hits_b", "n_b")))
    action = inspection.decision(F.col("improvement"), gap, sig, F.lit("low"), F.col("improving"), F.col("beneficial"))
    return one.select("lb", F.round("improvement", 9).alias("improvement"), F.round(gap, 9).alias("gap"), sig.alias("significant"), "improving", "beneficial", action.alias("action"))


#: Metrics of each day under one of several keys, now and then not a number.
METRICS = """
    SELECT CAST(ts AS DATE) AS day, avg(value) AS v, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1"""


def win_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a run over the days' metrics stops: the first number among the keys that a day has."""
    days = sql(spark, sf_dir, METRICS)
    value = F.round("v", 6).cast("string")
    metrics = F.when(F.col("n") % 4 == 0, F.create_map(F.lit("loss"), value)).when(F.col("n") % 4 == 1, F.create_map(F.lit("eval_reward"), F.lit("n/a"), F.lit("mean_reward"), value)).otherwise(F.create_map(F.lit("reward"), value))
    known = days.select("day", evaluation.reward_of(metrics).alias("v")).where("v is not null")
    series = known.agg(F.transform(F.sort_array(F.collect_list(F.struct("day", "v"))), lambda x: x["v"]).alias("values"))  # one value a day
    return series.select(stats.early_stop(F.col("values"), 0.01, 5).alias("s")).select(F.round("s.best", 6).alias("best"), F.col("s.since").cast("long").alias("since"), F.col("s.stopped_at").cast("long").alias("stopped_at"))


def win_nudges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, "SELECT l_orderkey AS conv_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS turn, l_returnflag = 'A' AS has_call FROM lineitem")
    return evaluation.nudges(rows, 2)


def win_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, "SELECT l_orderkey AS conv_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS turn, l_quantity * 100 AS tokens FROM lineitem")
    return evaluation.compacted(rows, 14336, 3)


def win_nearest_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.nearest_to_median(sql(spark, sf_dir, "SELECT doc_id, n_chars FROM documents"), "n_chars", "doc_id").select("doc_id", "n_chars", F.round("median", 6).alias("median"))


QUERIES = {
    f.__name__: f
    for f in (
        val_findings, reward_scores, pair_texts, rollout_parts, train_records, insp_notebooks, insp_findings, bundle_report, bundle_findings, cv_folds, cv_report, cv_per_repo, cv_subset, cv_fold_tiers,
        cv_verified, cmp_folds, cmp_decision, win_early_stop, win_nudges, win_compaction, win_nearest_median,
    )
}

_LEAKS = ["test_patch", "instance_id", "solution", "answer", "ground_truth", "gold_patch", "reference_patch"]
_FITS = ["specific task", "hardcoded", "manual fix", "if instance_id ==", "special case"]
_IDS = """len(regexp_extract_all(source, '["''](?:fastapi|rich|requests|httpx)_[0-9]+["'']'))"""
_HAS = lambda *words: "(" + " OR ".join(f"contains(low, '{w}')" for w in words) + ")"
_RAW = lambda *words: "(" + " OR ".join(f"contains(source, '{w}')" for w in words) + ")"
_FOUND = " UNION ALL ".join(
    [f"SELECT path, idx, 'data_leakage' AS \"check\", 'Leakage keyword ''{w}'' found in cell ' || idx AS finding FROM c WHERE contains(low, '{w}')" for w in _LEAKS]
    + [
        f"SELECT path, idx, 'data_leakage', 'CRITICAL: test_patch accessed during inference pipeline' FROM c WHERE {_RAW('test_patch')} AND {_RAW('agent', 'inference')}",
        f"SELECT path, idx, 'data_leakage', 'SUSPICIOUS: ' || {_IDS} || ' hardcoded instance_ids found' FROM c WHERE {_IDS} > 5",
        f"SELECT path, idx, 'data_leakage', 'WARNING: Possible test patch application in agent logic' FROM c WHERE {_RAW('/test_', 'test_patch')} AND {_RAW('apply', 'patch')}",
    ]
    + [f"SELECT path, idx, 'overfitting_patterns', 'Overfitting indicator ''{w}'' in cell ' || idx FROM c WHERE contains(low, '{w}')" for w in _FITS]
    + [
        f"SELECT path, idx, 'overfitting_patterns', 'CRITICAL: Manual patch dictionary detected' FROM c WHERE {_RAW('patch_map', 'manual_patches')}",
        "SELECT path, idx, 'overfitting_patterns', 'SUSPICIOUS: Only 1 training epoch — likely prompt-only submission' FROM c WHERE TRY_CAST(regexp_extract(source, 'num_(?:train_)?epochs\\s*[=:]\\s*([0-9]+)', 1) AS BIGINT) <= 1",
    ]
)
_CELLS = f"c AS (SELECT *, lower(source) AS low FROM ({CELLS.replace('5.0D', '5.0')}) a), found AS ({_FOUND})"
_PEERS = f"{RESULTS}, sides AS (SELECT id % 2 AS side, fold, arg_min(repo, id) AS val_repo, avg(CASE WHEN resolved THEN 1.0 ELSE 0.0 END) AS r, count(*) FILTER (resolved) AS hits, count(*) AS n FROM results GROUP BY ALL)"
_COMPARED = "compared AS (SELECT a.val_repo, arg_max(a.r, a.fold) AS peer, arg_max(b.r, a.fold) AS baseline FROM sides a JOIN sides b ON a.fold = b.fold AND a.side = 0 AND b.side = 1 GROUP BY a.val_repo)"
_SUFFIX = "regexp_extract(lower(regexp_extract(path, '[^/]*$')), '[^.]([.][^.]*)$', 1)"

_BLOCK = lambda role, content: f"'<|turn>{role}' || chr(10) || {content} || chr(10) || '<turn|>'"
_THINK = lambda text: f"'<|channel>thought' || chr(10) || {text} || chr(10) || '<channel|>' || chr(10)"
_CALL = lambda name, args: f"chr(10) || '<|tool_call>' || chr(10) || '{{\"tool_name\": \"{name}\", \"args\": {{' || {args} || '}}}}' || chr(10) || '<tool_call|>'"
_SAID = lambda thought, text, name, args: _BLOCK("model", _THINK(thought) + f" || {text} || " + _CALL(name, args))
_TOLD = lambda result: _BLOCK("user", result)


def _chats() -> str:
    """DuckDB SQL of all chats: a file has one hunk that begins at line 1, no line defines a symbol, and statements hold no quotes."""
    first = _BLOCK("user", "'You are evaluating a software engineering task for repository ' || repo || '.' || chr(10) || chr(10) || 'Problem Statement:' || chr(10) || 'The parser fails on order ' || id || chr(10) || chr(10) || '## Hints:' || chr(10) || chr(10) || chr(10) || $rules$" + trajectories.TASK_RULES.strip() + "$rules$")
    search = _SAID("'The problem mentions parser, fails, order. Searching for add_numbers.'", "'Let me search for the relevant code in the repository.'", "search_similar_code", """'"query": "add_numbers", "k": 5'""")
    found = _TOLD("""'{"status": "ok", "query": "add_numbers", "results": [{"node_name": "add_numbers", "filepath": "utils.py", "score": 0.95}], "count": 1}'""")
    near = _SAID("'Found add_numbers. Examining code neighbors.'", "'Examining the call graph for this function.'", "get_code_neighbors", """'"node": "add_numbers"'""")
    edges = _TOLD("""'{"status": "ok", "node": "add_numbers", "neighbors": [{"source": "add_numbers", "target": "add_numbers_caller", "type": "calls"}], "count": 1}'""")
    read = lambda by: _SAID("'Reading ' || path || ' around line 1.'", "'Reading `' || path || '`.'", "read_file", f"""'"filepath": "' || path || '", "start_line": 1, "end_line": ' || (31 + n + {by})""")
    shown = _TOLD("""'{"status": "ok", "filepath": "' || path || '", "start_line": 1, "end_line": ' || (31 + n) || ', "content": "# Content for ' || path || ' lines 1-' || (31 + n) || '"}'""")
    edit = _SAID("'Fixing ' || path || ' at line 1.'", "'Applying patch to `' || path || '`.'", "edit_file", """'"filepath": "' || path || '", "old_string": "' || coalesce(old, '') || '", "new_string": "' || coalesce(new, '') || '"'""")
    edited = _TOLD("""'{"status": "ok", "filepath": "' || path || '", "occurrences": 1, "strategy": "exact"}'""")
    cause = _BLOCK("model", _THINK("'Root cause identified. Preparing patch modifications.'") + " || 'Root cause identified. Proceeding to fix.'")
    tests = _SAID("'Running test suite to verify the applied fix.'", "'Running verification tests.'", "run_command", """'"command": "python -m pytest -q"'""")
    passed = _TOLD("""'{"status": "ok", "returncode": 0, "output": "1 passed in 0.05s"}'""")
    submit = _SAID("'All verification tests pass. Submitting completed patch.'", "'All tests passed. Submitting patch.'", "submit_patch", "''")
    sent = _TOLD("""'{"status": "ok", "message": "Patch submitted successfully."}'""")
    alone = lambda thought, name, args: _BLOCK("model", f"'<|channel>thought' || chr(10) || {thought} || chr(10) || '<channel|>' || " + _CALL(name, args))
    grep, hit = _SAID("'The problem mentions parser, fails, order. Searching for add_numbers.'", "'Let me search for the relevant code in the repository.'", "run_command", """'"command": "grep -rn ''add_numbers'' ."'"""), _TOLD("""'{"status": "ok", "returncode": 0, "output": "src/utils.py:10: def foo():"}'""")
    failed = ", ".join([alone("'Attempting to apply patch.'", "edit_file", r"""'"filepath": "' || paths[1] || '", "old_string": "INVALID_OLD_STRING_FOR_ERROR_RECOVERY\n", "new_string": ""'"""), _TOLD("""'{"status": "error", "message": "old_string not found"}'"""), _BLOCK("model", _THINK("'The edit failed. Re-reading context and correcting edit pattern.'") + " || 'Correcting the patch.'")])
    ran = _TOLD("""'{"status": "ok", "returncode": 0, "output": ""}'""")
    scratch = ", ".join([alone("'Writing reproduction script to verify the issue.'", "write_file", r"""'"filepath": "/tmp/repro.py", "content": "# Reproduction script\nassert True\n"'"""), _TOLD("""'{"status": "ok", "bytes_written": 32}'"""), alone("'Executing reproduction script.'", "run_command", """'"command": "python /tmp/repro.py"'"""), ran, alone("'Cleaning up temporary reproduction files.'", "run_command", """'"command": "rm -f /tmp/repro.py"'"""), ran])
    status = alone("'Checking current execution budget.'", "get_status", "''") + ", " + _TOLD("""'{"status": "ok", "remaining_time_min": 45.0, "tool_calls_remaining": 85}'""")
    lines = lambda flag: f"string_agg('line_' || l_linenumber || '_' || l_partkey, '{chr(92)}n' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (l_returnflag <> '{flag}')"
    return f"""
        f AS (SELECT l_orderkey AS id, p_brand || '.py' AS path, count(*) AS n, count(*) FILTER (l_returnflag <> 'A') AS n_old, count(*) FILTER (l_returnflag <> 'N') AS changed, {lines("A")} AS old, {lines("R")} AS new FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_brand),
        b AS (SELECT id, path, n, n_old, changed, {read(0)} AS seen, {read(10)} AS wide, {shown} AS shown, {edit} AS made, {edited} AS edited FROM f),
        t AS (SELECT id, count(*) AS files, sum(changed) AS lines, bool_and(n_old > 0) AS good, list(path ORDER BY path) AS paths, flatten(list([seen, shown] ORDER BY path)) AS reads, flatten(list([wide, shown] ORDER BY path)) AS wide, flatten(list([made, edited] ORDER BY path)) AS edits FROM b GROUP BY id),
        folds AS (SELECT repo, (row_number() OVER (ORDER BY repo) - 1) % 4 AS fold FROM (SELECT DISTINCT c_mktsegment AS repo FROM customer) a),
        names AS (SELECT unnest(['swap_navigation', 'failed_edit', 'wider_reads', 'grep_first', 'scratch_block', 'budget_checks']) AS strategy),
        picked AS (SELECT id, strategy, row_number() OVER (PARTITION BY id ORDER BY md5('42:' || id || ':' || strategy), strategy) AS k FROM t CROSS JOIN names),
        every AS (SELECT id, NULL AS strategy FROM t UNION ALL SELECT id, strategy FROM picked WHERE k <= 3),
        tasks AS (SELECT t.*, strategy, c_mktsegment AS repo, CAST(t.id AS VARCHAR) AS instance_id, CASE WHEN files <= 1 AND lines < 20 THEN 'SIMPLE' WHEN files <= 3 AND lines <= 100 THEN 'MODERATE' ELSE 'COMPLEX' END AS complexity
                  FROM every JOIN t ON every.id = t.id JOIN orders ON o_orderkey = t.id JOIN customer ON c_custkey = o_custkey),
        whole AS (SELECT *, list_concat([{first}], CASE strategy WHEN 'swap_navigation' THEN [{near}, {edges}, {search}, {found}] WHEN 'grep_first' THEN [{grep}, {hit}, {near}, {edges}] ELSE [{search}, {found}, {near}, {edges}] END,
                                           CASE strategy WHEN 'wider_reads' THEN wide ELSE reads END, [{cause}], CASE strategy WHEN 'failed_edit' THEN [{failed}] ELSE [] END, edits, [{tests}, {passed}, {submit}, {sent}]) AS plain FROM tasks),
        chats AS (SELECT *, CASE strategy WHEN 'scratch_block' THEN list_concat(plain[:2], [{scratch}], plain[3:])
                                          WHEN 'budget_checks' THEN list_concat(plain[:len(plain) // 3], [{status}], plain[len(plain) // 3 + 1:2 * len(plain) // 3], [{status}], plain[2 * len(plain) // 3 + 1:]) ELSE plain END AS blocks FROM whole)"""


_CHATS = _chats()

ORACLE = {
    "val_findings": f"""
        WITH c AS ({CALLS}), m AS ({META}),
             e AS (SELECT id, 1 AS g, 0 AS k, 'Token count ' || token_count || ' exceeds 28672' AS msg FROM m WHERE token_count > 28672
                   UNION ALL SELECT id, 2, k, 'edit_file missing old_string for ' || path FROM c WHERE tool = 'edit_file' AND old = ''
                   UNION ALL SELECT id, 3, k, 'Modifies test file: ' || path FROM c WHERE tool IN ('edit_file', 'write_file') AND regexp_matches(lower(path), {TEST_PATH})
                   UNION ALL SELECT id, 4, k, 'Scratch file in workspace: ' || path FROM c WHERE tool = 'write_file' AND regexp_matches(lower(path), {SCRATCH_PATH}) AND NOT starts_with(path, '/tmp/')),
             w AS (SELECT id, 1 AS g, 'Tool calls ' || num_tool_calls || ' exceeds recommended 80' AS msg FROM m WHERE num_tool_calls > 80
                   UNION ALL SELECT id, 2, 'submit_patch is not the last tool call' FROM c WHERE k = 3 AND tool <> 'submit_patch'),
             es AS (SELECT id, string_agg(msg, '|' ORDER BY g, k) AS errors FROM e GROUP BY id), ws AS (SELECT id, string_agg(msg, '|' ORDER BY g) AS warnings FROM w GROUP BY id)
        SELECT m.id, coalesce(errors, '') AS errors, coalesce(warnings, '') AS warnings, errors IS NULL AS valid FROM m LEFT JOIN es ON m.id = es.id LEFT JOIN ws ON m.id = ws.id""",
    "reward_scores": f"""
        WITH c AS ({CALLS}), m AS ({META}),
             n AS (SELECT id, count(*) FILTER (tool = 'write_file' AND regexp_matches(lower(path), {SCRATCH_PATH}) AND NOT starts_with(path, '/tmp/')) AS scratch,
                          count(*) FILTER (tool IN ('edit_file', 'write_file') AND regexp_matches(lower(path), {TEST_PATH})) AS tests, count(*) AS calls FROM c GROUP BY id),
             x AS (SELECT m.*, scratch, tests, calls, CASE complexity WHEN 'SIMPLE' THEN 6 WHEN 'MODERATE' THEN 12 ELSE 20 END AS med FROM m JOIN n ON m.id = n.id)
        SELECT id, round(least(1.3, greatest(-1.5, CASE WHEN trim(patch) = '' THEN -1.0 WHEN total > 0 AND passed = total THEN 1.0 WHEN total > 0 AND passed > 0 THEN 0.5 * passed / total ELSE -0.5 END
                   + CASE WHEN calls < 0.7 * med THEN 0.15 WHEN calls < med THEN 0.15 * (1 - calls / med) ELSE 0 END
                   - CASE WHEN had_truncation THEN 0.2 ELSE 0 END - 0.3 * scratch - 0.5 * tests - 0.1e0 * power(greatest(token_count - 24000, 0) / 4000.0e0, 2))), 9) AS reward FROM x""",
    "pair_texts": """
        WITH p AS (SELECT conv_id, turn, 1 AS k, '<|channel>thought' || chr(10) || 'step ' || turn || chr(10) || '<channel|>' AS part FROM conversations WHERE role = 'assistant' AND conv_id % 7 <> 0
                   UNION ALL SELECT conv_id, turn, 2, text FROM conversations WHERE conv_id % 7 <> 0 AND text <> ''),
             t AS (SELECT conv_id, string_agg(part, chr(10) ORDER BY turn, k) AS text FROM p GROUP BY conv_id)
        SELECT c.conv_id, sha256(coalesce(text, 'patch ' || c.conv_id)) AS text_sha, '<|turn>user' || chr(10) || 'Problem: ' || c.conv_id || chr(10) || '<turn|>' || chr(10) AS prompt
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN t ON c.conv_id = t.conv_id""",
    "rollout_parts": f"""
        WITH r AS ({RAW}), g AS (SELECT 0 AS gen, 1 AS extra UNION ALL SELECT 1, 0)
        SELECT conv_id || '-' || turn AS instance_id, gen, CASE WHEN r % 5 <> 0 THEN 'think ' || r END AS thought, CASE r % 4 WHEN 0 THEN 'submit_patch' WHEN 1 THEN 'run_command' WHEN 2 THEN '' ELSE 'grep' END AS tools,
               CASE r % 4 WHEN 0 THEN 'Patch submitted.' WHEN 1 THEN 'Command executed successfully with return code 0.' WHEN 3 THEN 'Tool executed: grep' END AS told,
               CASE WHEN r % 4 = 0 THEN 'P' || r WHEN r % 3 = 0 THEN 'T' || r WHEN r % 3 = 1 THEN 'diff --git a/x b/x' || chr(10) || '+' || r END AS patch,
               greatest(1, (length(raw) + extra) // 4) AS token_count, CASE WHEN r % 4 = 2 THEN 0 ELSE 1 END AS n_calls, CASE WHEN r % 4 = 0 OR r % 3 < 2 THEN 1 ELSE 0 END AS n_files FROM r CROSS JOIN g""",
    "train_records": f"""
        WITH {_CHATS} SELECT instance_id, repo, complexity, strategy, len(blocks) AS n_messages, sha256('<bos>' || array_to_string(blocks, chr(10)) || chr(10)) AS text_sha,
               4 + 2 * files + CASE strategy WHEN 'failed_edit' THEN 1 WHEN 'scratch_block' THEN 3 WHEN 'budget_checks' THEN 2 ELSE 0 END AS n_calls, files AS n_files, fold
        FROM chats JOIN folds USING (repo) WHERE good""",
    "insp_findings": f'WITH {_CELLS} SELECT "check", finding, count(*) AS n FROM found GROUP BY ALL',
    "insp_notebooks": f"""
        WITH {_CELLS}, n AS (SELECT path, count(*) FILTER ("check" = 'data_leakage') AS n_leaks, count(*) FILTER ("check" = 'overfitting_patterns') AS n_fits,
                 count(*) FILTER ("check" = 'data_leakage' AND contains(finding, 'CRITICAL')) AS bad_leaks, count(*) FILTER ("check" = 'overfitting_patterns' AND contains(finding, 'CRITICAL')) AS bad_fits,
                 count(*) FILTER (contains(finding, 'SUSPICIOUS')) AS odd FROM found GROUP BY path),
             l AS (SELECT path, bool_or({_HAS('agenttool', 'delegat', 'multi_agent', 'coordinator')}) AS multi, bool_or({_HAS('react', 'tool_call', 'agent')}) AS react, bool_or({_HAS('grpo')}) AS grpo, bool_or({_HAS('dpo')}) AS dpo,
                 bool_or({_HAS('sft', 'lora')}) AS lora, bool_or({_HAS('train')}) AS train, bool_or({_HAS('reflection')}) AS t1, bool_or({_HAS('tree_of_thought', 'tot')}) AS t2, bool_or({_HAS('curriculum')}) AS t3,
                 bool_or({_HAS('best_of_n', 'test_time_compute')}) AS t4, bool_or({_HAS('pruning', 'dynamic_context')}) AS t5, bool_or({_HAS('subagent', 'agent_tool')}) AS t6, bool_or({_HAS('dynamic_budget')}) AS t7,
                 count(DISTINCT CASE idx % 31 WHEN 14 THEN 'be good' END) + count(DISTINCT CASE idx % 31 WHEN 15 THEN 'a' END) + count(DISTINCT CASE idx % 31 WHEN 15 THEN 'b' END) AS n_prompts FROM c GROUP BY path)
        SELECT l.path, coalesce(n_leaks, 0) AS n_leaks, coalesce(n_leaks, 0) = 0 AS leak_passed, CASE WHEN coalesce(n_leaks, 0) = 0 THEN 'info' WHEN bad_leaks > 0 THEN 'critical' ELSE 'warning' END AS leak_severity,
               coalesce(n_fits, 0) AS n_fits, coalesce(bad_fits, 0) = 0 AS overfit_passed, CASE WHEN coalesce(n_fits, 0) = 0 THEN 'info' WHEN bad_fits > 0 THEN 'critical' ELSE 'warning' END AS overfit_severity,
               CASE WHEN bad_leaks + bad_fits > 0 THEN 'critical' WHEN odd > 0 THEN 'medium' WHEN n_leaks + n_fits > 0 THEN 'low' ELSE 'clean' END AS risk_level,
               CASE WHEN multi THEN 'multi_agent' WHEN react THEN 'single_agent_react' ELSE 'standard_agent' END AS architecture,
               CASE WHEN grpo THEN 'grpo_rl' WHEN dpo THEN 'dpo_rl' WHEN lora THEN 'sft_lora' WHEN train THEN 'supervised_training' ELSE 'prompt_only' END AS training,
               concat_ws(',', CASE WHEN t1 THEN 'reflection' END, CASE WHEN t2 THEN 'tree_of_thought' END, CASE WHEN t3 THEN 'curriculum_learning' END, CASE WHEN t4 THEN 'best_of_n_sampling' END, CASE WHEN t5 THEN 'context_pruning' END,
                         CASE WHEN t6 THEN 'multi_agent_delegation' END, CASE WHEN t7 THEN 'dynamic_budgeting' END) AS techniques, n_prompts FROM l LEFT JOIN n ON l.path = n.path""",
    "bundle_report": f"""
        WITH f AS ({FILES.replace('10.0D', '10.0')}), x AS (SELECT *, {_SUFFIX} AS ext, regexp_extract(path, '^adapters/([^./][^/]*)/', 1) AS adapter FROM f),
             a AS (SELECT bundle, adapter, bool_or(path = 'adapters/' || adapter || '/adapter_config.json') AND bool_or(ext = '.safetensors') AS whole FROM x WHERE adapter <> '' GROUP BY ALL),
             b AS (SELECT bundle, bool_and(whole) AS whole, count(*) AS n FROM a GROUP BY bundle),
             s AS (SELECT bundle, bool_or(path = 'agent.yaml') AS root, sum(CASE WHEN is_link THEN 0 ELSE length END) <= 3221225472 AS fits, bool_or(ext IN ('.bin', '.pt', '.pth', '.pkl', '.pickle')) AS forbidden,
                          bool_or(contains(content, '!include ../') OR contains(content, '[unclosed')) AS climbs, count(DISTINCT split_part(split_part(CASE WHEN ext IN ('.yaml', '.yml') AND NOT contains(content, '[unclosed') THEN content END, chr(10), 1), 'model: ', 2)) AS models, bool_or(is_link) AS links,
                          max(CASE WHEN path LIKE '%a1/adapter_config.json' THEN 124 + bundle % 6 WHEN path LIKE '%a2/adapter_config.json' THEN 120 + bundle % 11 ELSE 0 END) AS rank,
                          bool_or(path = 'agent.yaml' AND bundle % 5 <> 0 AND (32766 + bundle % 4 > 32768 OR bundle % 7 - 5 > 0)) AS over FROM x GROUP BY bundle),
             j AS (SELECT s.*, coalesce(whole, TRUE) AS whole, coalesce(n, 0) AS n FROM s LEFT JOIN b ON s.bundle = b.bundle)
        SELECT bundle, 'root_config' AS name, root AS passed FROM j UNION ALL SELECT bundle, 'total_size', fits FROM j UNION ALL SELECT bundle, 'extensions', NOT forbidden FROM j UNION ALL SELECT bundle, 'adapters', whole FROM j
        UNION ALL SELECT bundle, 'yaml_schema', NOT coalesce(climbs, FALSE) FROM j UNION ALL SELECT bundle, 'single_model', models = 1 FROM j UNION ALL SELECT bundle, 'no_symlinks', NOT links FROM j
        UNION ALL SELECT bundle, 'adapter_count', n <= 8 FROM j UNION ALL SELECT bundle, 'lora_rank', rank <= 128 FROM j UNION ALL SELECT bundle, 'token_limits', root AND NOT over FROM j""",
    "bundle_findings": f"""
        WITH f AS ({FILES.replace('10.0D', '10.0')}), x AS (SELECT *, {_SUFFIX} AS ext, contains(content, '[unclosed') AS broken FROM f),
             b AS (SELECT bundle, count(*) FILTER (path = 'agent.yaml') AS roots, count(*) FILTER (ext IN ('.yaml', '.yml') AND NOT broken) AS readable, sum(length) AS bytes,
                          count(DISTINCT CASE WHEN ext IN ('.yaml', '.yml') AND NOT broken THEN split_part(content, chr(10), 1) END) AS models FROM x GROUP BY bundle),
             e AS (SELECT bundle, 'error' AS severity, 'YAML parses' AS "check" FROM x WHERE broken UNION ALL SELECT bundle, 'error', 'allowed file types' FROM x WHERE ext NOT IN ('.yaml', '.yml', '.md', '.txt', '.py', '.json', '.safetensors')
                   UNION ALL SELECT bundle, 'warning', 'no hidden / cache files' FROM x WHERE path LIKE '%/.cache/%' UNION ALL SELECT bundle, 'error', 'exactly one root config' FROM b WHERE roots <> 1
                   UNION ALL SELECT bundle, 'error', 'YAML files parse' FROM b WHERE readable = 0 UNION ALL SELECT bundle, 'error', 'single base model' FROM b WHERE models <> 1 UNION ALL SELECT bundle, 'error', 'size limit' FROM b WHERE bytes > 3221225472
                   UNION ALL SELECT bundle, 'error', 'references resolve inside the bundle' FROM b WHERE bundle % 13 = 0 OR bundle % 13 = 7 AND roots = 0 UNION ALL SELECT bundle, 'warning', 'only verified tools referenced' FROM b WHERE bundle % 13 = 7)
        SELECT bundle, severity, "check", count(*) AS n FROM e GROUP BY ALL""",
    "cv_folds": f"""
        WITH {RESULTS} SELECT fold, arg_min(repo, id) AS val_repo, count(*) AS total, count(*) FILTER (resolved) AS n_resolved, round(count(*) FILTER (resolved) / count(*), 9) AS resolution_rate, round(avg(tools), 9) AS avg_tool_calls,
               round(avg(tokens), 9) AS avg_tokens, round(count(*) FILTER (truncated) / count(*), 9) AS truncation_rate, count(*) FILTER (tier = 'SIMPLE') AS n_simple, count(*) FILTER (tier = 'MODERATE') AS n_moderate,
               count(*) FILTER (tier = 'COMPLEX') AS n_complex FROM results GROUP BY fold""",
    "cv_report": f"""
        WITH {RESULTS}, f AS (SELECT fold, arg_min(repo, id) AS val_repo, count(*) FILTER (resolved) / count(*) AS r, count(*) FILTER (truncated) / count(*) AS t, avg(tools) AS u FROM results GROUP BY fold),
             p AS (SELECT val_repo, arg_max(r, fold) AS r, min(fold) AS place FROM f GROUP BY val_repo), w AS (SELECT * FROM p ORDER BY r, place LIMIT 1),
             x AS (SELECT count(*) FILTER (resolved) / count(*) AS rate, count(*) FILTER (resolved AND tier = 'SIMPLE') / count(*) FILTER (tier = 'SIMPLE') AS simple,
                          count(*) FILTER (resolved AND tier = 'MODERATE') / count(*) FILTER (tier = 'MODERATE') AS moderate, count(*) FILTER (resolved AND tier = 'COMPLEX') / count(*) FILTER (tier = 'COMPLEX') AS complex FROM results)
        SELECT round(rate, 9) AS resolution_rate, round(simple, 9) AS simple, round(moderate, 9) AS moderate, round(complex, 9) AS complex, (SELECT count(*) FROM f) AS n_folds,
               concat_ws('|', CASE WHEN rate < 0.2 THEN 'CRITICAL: Resolution rate below 20%. Focus on SFT data quality and tool-call syntax accuracy before RL training.' END,
                   CASE WHEN w.r < 0.5 * rate THEN 'WARNING: Weak repository resolution in ' || w.val_repo || '. Add more diverse training trajectories for this repo type.' END,
                   CASE WHEN complex < 0.3 * simple THEN 'WARNING: Complex tasks resolve at <30% of simple task rate. Increase multi-file trajectory training and raise tool budget.' END,
                   CASE WHEN (SELECT avg(t) FROM f) > 0.05 THEN 'WARNING: Truncation rate exceeds 5% threshold. Reduce thinking_budget or split edit_file payloads.' END,
                   CASE WHEN (SELECT avg(u) FROM f) > 60 THEN 'WARNING: Average tool usage is high (>60 calls). Add efficiency bonus to RL reward signal.' END) AS recommendations FROM x CROSS JOIN w""",
    "cv_per_repo": f"WITH {RESULTS}, f AS (SELECT fold, arg_min(repo, id) AS val_repo, count(*) FILTER (resolved) / count(*) AS r FROM results GROUP BY fold) SELECT val_repo, round(arg_max(r, fold), 9) AS rate FROM f GROUP BY val_repo",
    "cv_subset": f"WITH {RESULTS} SELECT -1 AS fold, 'mixed' AS val_repo, count(*) AS total, count(*) FILTER (resolved) AS n_resolved, round(coalesce(count(*) FILTER (resolved) / nullif(count(*), 0), 0), 9) AS resolution_rate FROM results WHERE id % 50 = 0",
    "cv_fold_tiers": f"""WITH {RESULTS} SELECT fold, count(*) FILTER (tier = 'SIMPLE') AS "SIMPLE", count(*) FILTER (tier = 'MODERATE') AS "MODERATE", count(*) FILTER (tier = 'COMPLEX') AS "COMPLEX" FROM results WHERE id % 3 = 0 GROUP BY fold""",
    "cv_verified": f"""
        WITH v AS ({VERIFIED.replace('40.0D', '40.0')}), g AS (SELECT *, num_tool_calls > 80 OR elapsed_seconds > 40 AS over FROM v), p AS (SELECT *, CASE WHEN over THEN NULL ELSE patch END AS q FROM g),
             r AS (SELECT *, coalesce(trim(q), '') = '' AS empty, exit_code = 0 AND CASE WHEN passed IS NULL THEN TRUE ELSE passed > 0 AND failed = 0 AND coalesce(errors, 0) = 0 END AS ok FROM p)
        SELECT id, q AS patch, over OR had_truncation AS had_truncation, NOT empty AND ok AS resolved, CASE WHEN empty THEN 'No patch generated' WHEN NOT ok THEN 'Tests failed' END AS error FROM r""",
    "cmp_folds": f"WITH {_PEERS}, {_COMPARED} SELECT val_repo, round(peer, 9) AS peer, round(baseline, 9) AS baseline, round(peer - baseline, 9) AS delta FROM compared",
    "cmp_decision": f"""
        WITH {_PEERS}, {_COMPARED}, s AS (SELECT sum(hits) FILTER (side = 0) AS a, sum(n) FILTER (side = 0) AS na, sum(hits) FILTER (side = 1) AS b, sum(n) FILTER (side = 1) AS nb FROM sides),
             x AS (SELECT *, unnest(generate_series(CAST(a AS BIGINT), CAST(least(a + b, na) AS BIGINT))) AS x FROM s),
             p AS (SELECT coalesce(sum(exp(lgamma(na + 1) - lgamma(x + 1) - lgamma(na - x + 1) + lgamma(nb + 1) - lgamma(a + b - x + 1) - lgamma(nb - a - b + x + 1) - lgamma(na + nb + 1) + lgamma(a + b + 1) + lgamma(na + nb - a - b + 1))), 0) AS p
                   FROM x WHERE a + b - x BETWEEN 0 AND nb),
             y AS (SELECT a / na AS ra, b / nb AS rb, a * nb > b * na AND p < 0.05 AS significant, (SELECT count(*) FROM compared WHERE peer > baseline) AS improving,
                          (SELECT count(*) FROM (SELECT id % 7 AS t, avg(CASE WHEN resolved THEN 1.0 ELSE 0.0 END) AS r FROM results GROUP BY 1) q WHERE r - (a + b) / (na + nb) > 0.001) AS beneficial FROM s CROSS JOIN p),
             z AS (SELECT *, ra - rb AS improvement, unnest([0.3, 0.5, 0.9]) AS lb FROM y)
        SELECT CAST(lb AS DOUBLE) AS lb, round(improvement, 9) AS improvement, round(abs(ra - CAST(lb AS DOUBLE)), 9) AS gap, significant, improving, beneficial,
               CASE WHEN abs(ra - lb) > 0.2 THEN 'REJECT' WHEN improvement > 0.05 AND significant AND abs(ra - lb) < 0.1 AND improving >= 3 THEN 'ADOPT' WHEN improvement > 0.02 AND significant AND beneficial > 0 THEN 'PARTIAL_ADOPT' ELSE 'REJECT' END AS action FROM z""",
    "win_early_stop": f"""
        WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY day) - 1 AS k, round(v, 6) AS v FROM ({METRICS}) a WHERE n % 4 <> 0),
             s AS (SELECT CAST(-1 AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS best, 0 AS since, CAST(NULL AS BIGINT) AS stopped
                   UNION ALL SELECT d.k, CASE WHEN best IS NULL OR d.v >= best + 0.01 THEN d.v ELSE best END, CASE WHEN best IS NULL OR d.v >= best + 0.01 THEN 0 ELSE since + 1 END,
                             CASE WHEN NOT (best IS NULL OR d.v >= best + 0.01) AND since + 1 >= 5 THEN d.k END FROM s JOIN d ON d.k = s.k + 1 WHERE stopped IS NULL)
        SELECT round(best, 6) AS best, since, stopped AS stopped_at FROM s ORDER BY k DESC LIMIT 1""",
    "win_nudges": """
        WITH t AS (SELECT l_orderkey AS conv_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS turn, l_returnflag = 'A' AS has_call FROM lineitem),
             c AS (SELECT *, max(CASE WHEN has_call THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS latest FROM t)
        SELECT conv_id, turn, turn - coalesce(latest, 0) AS run, turn - coalesce(latest, 0) > 2 AS stops FROM c""",
    "win_compaction": """
        WITH t AS (SELECT l_orderkey AS conv_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS turn, l_quantity * 100 AS tokens FROM lineitem)
        SELECT conv_id, turn, sum(tokens) OVER (PARTITION BY conv_id) <= 14336 OR turn = 1 OR turn > count(*) OVER (PARTITION BY conv_id) - 3 AS kept FROM t""",
    "win_nearest_median": "SELECT doc_id, n_chars, round((SELECT median(n_chars) FROM documents), 6) AS median FROM documents ORDER BY abs(n_chars - (SELECT median(n_chars) FROM documents)), doc_id LIMIT 1",
}
