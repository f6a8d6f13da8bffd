"""Static inspection of notebooks, bundle checks, and decisions on peers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.text import stripped
from quarryline.operators.configs import yaml_facts

# Words and patterns of each scan, names of checks, labels with their words in order of precedence, limits of bundles.
LEAK_WORDS = ["test_patch", "instance_id", "solution", "answer", "ground_truth", "gold_patch", "reference_patch"]
OVERFIT_WORDS = ["specific task", "hardcoded", "manual fix", "if instance_id ==", "special case"]
ID_PATTERN = r"""["'](?:fastapi|rich|requests|httpx)_\d+["']"""
EPOCH_PATTERN = r"num_(?:train_)?epochs\s*[=:]\s*(\d+)"
PROMPT_PATTERN = r"""(?i)(?:system_prompt|prompt)\s*=\s*["']{1,3}([\s\S]*?)["']{1,3}"""
LEAKAGE, OVERFITTING = "data_leakage", "overfitting_patterns"
ONE_EPOCH = "SUSPICIOUS: Only 1 training epoch — likely prompt-only submission"
ARCHITECTURES = [("multi_agent", ["agenttool", "delegat", "multi_agent", "coordinator"]), ("single_agent_react", ["react", "tool_call", "agent"])]
TRAININGS = [("grpo_rl", ["grpo"]), ("dpo_rl", ["dpo"]), ("sft_lora", ["sft", "lora"]), ("supervised_training", ["train"])]
TECHNIQUES = [
    ("reflection", ["reflection"]), ("tree_of_thought", ["tree_of_thought", "tot"]), ("curriculum_learning", ["curriculum"]),
    ("best_of_n_sampling", ["best_of_n", "test_time_compute"]), ("context_pruning", ["pruning", "dynamic_context"]),
    ("multi_agent_delegation", ["subagent", "agent_tool"]), ("dynamic_budgeting", ["dynamic_budget"]),
]
FORBIDDEN = [".bin", ".pt", ".pth", ".pkl", ".pickle"]
ROOT_CONFIG, ADAPTERS, ADAPTER_CONFIG, WEIGHTS = "agent.yaml", "adapters", "adapter_config.json", ".safetensors"
MOST_BYTES, MOST_ADAPTERS, MOST_RANK = 3 * 1024**3, 8, 128


def has_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def leak_findings(source: Column, index: Column) -> Column:
    """Findings in one code cell: words, a test patch at inference, many task ids, a test patch applied."""
    low, cell = F.lower(source), index.cast("string")
    ids = F.regexp_count(source, F.lit(ID_PATTERN))
    words = [F.when(F.contains(low, F.lit(w)), F.concat(F.lit(f"Leakage keyword '{w}' found in cell "), cell)) for w in LEAK_WORDS]
    rules = [
        F.when(F.contains(source, F.lit("test_patch")) & has_any(source, ["agent", "inference"]), F.lit("CRITICAL: test_patch accessed during inference pipeline")),
        F.when(ids > 5, F.concat(F.lit("SUSPICIOUS: "), ids.cast("string"), F.lit(" hardcoded instance_ids found"))),
        F.when(has_any(source, ["/test_", "test_patch"]) & has_any(source, ["apply", "patch"]), F.lit("WARNING: Possible test patch application in agent logic")),
    ]
    return F.array_compact(F.array(*words, *rules))


def overfit_findings(source: Column, index: Column) -> Column:
    """Findings in one code cell: words, a dictionary of patches, one epoch at most."""
    low, cell = F.lower(source), index.cast("string")
    epochs = F.nullif(F.regexp_extract(source, EPOCH_PATTERN, 1), F.lit("")).cast("decimal(38,0)")
    words = [F.when(F.contains(low, F.lit(w)), F.concat(F.lit(f"Overfitting indicator '{w}' in cell "), cell)) for w in OVERFIT_WORDS]
    rules = [F.when(has_any(source, ["patch_map", "manual_patches"]), F.lit("CRITICAL: Manual patch dictionary detected")), F.when(epochs <= 1, F.lit(ONE_EPOCH))]
    return F.array_compact(F.array(*words, *rules))


def scan(cells: DataFrame) -> DataFrame:
    """(path, index, check, finding): one row for each finding in code cells (path, index, source)."""
    found = F.array(
        F.struct(F.lit(LEAKAGE).alias("check"), leak_findings(F.col("source"), F.col("index")).alias("f")),
        F.struct(F.lit(OVERFITTING).alias("check"), overfit_findings(F.col("source"), F.col("index")).alias("f")),
    )
    rows = cells.select("path", "index", F.explode(found).alias("x"))
    return rows.select("path", "index", "x.check", F.explode("x.f").alias("finding"))


def word_hits(texts: DataFrame, key: str, text: str, words: list[str]) -> DataFrame:
    """(key, keyword): the words that each text holds, in lower case; a text is read once and gives a row only for each word found."""
    low = F.lower(F.col(text))
    found = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(w)), F.lit(w)) for w in words)))
    return texts.select(key, F.explode(found).alias("keyword"))


def verbatim(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): texts (doc_id, text) that hold an item (item_id, text) as it stands.

    An item's second to fourth parts between spaces stand between spaces in any text that holds it: texts and items meet by these
    three, and only such pairs are compared. Items of less than five parts have no such anchor; these are compared with all
    texts, behind a check of their number.
    """
    parts = F.split("text", " ")
    anchored = items.where(F.size(parts) >= 5).select("item_id", F.col("text").alias("wanted"), F.array_join(F.slice(parts, 2, 3), " ").alias("anchor"))
    triples = F.regexp_extract_all("text", F.lit("(?<![^ ])(?=([^ ]* [^ ]* [^ ]*))"), F.lit(1))  # a text is read once, not once a part
    seen = texts.where(F.size(parts) >= 3).select("doc_id", "text", F.explode(F.array_distinct(triples)).alias("anchor"))
    keys = anchored.select("anchor").distinct()
    hits = seen.select("doc_id", "anchor").join(keys, "anchor", "left_semi")
    pairs = hits.join(anchored, "anchor").join(texts.select("doc_id", "text"), "doc_id").where(F.contains("text", F.col("wanted"))).select("doc_id", "item_id")
    short = items.where(F.size(parts) < 5)
    if short.take(1):
        if short.count() > 10_000:
            raise ValueError("at most 10,000 items of less than five parts at a time")
        few = F.broadcast(short.select("item_id", F.col("text").alias("wanted")))
        pairs = pairs.unionByName(texts.join(few, F.contains("text", F.col("wanted"))).select("doc_id", "item_id"))
    return pairs.distinct()


def first_label(text: Column, labels: list[tuple[str, list[str]]], default: str) -> Column:
    out = F.lit(default)
    for label, words in reversed(labels):
        out = F.when(has_any(text, words), F.lit(label)).otherwise(out)
    return out


def techniques(text: Column) -> Column:
    return F.array_compact(F.array(*(F.when(has_any(text, words), F.lit(label)) for label, words in TECHNIQUES)))


def prompts(source: Column) -> Column:
    """Prompt texts that a cell assigns, stripped, without empty ones."""
    found = F.transform(F.regexp_extract_all(source, F.lit(PROMPT_PATTERN), F.lit(1)), stripped)
    return F.filter(found, lambda x: x != "")


def inspect(cells: DataFrame) -> DataFrame:
    """One row for each notebook of code cells (path, index, source): checks, labels, prompts and risk.

    A notebook's cells are read together once; labels are looked for in all code joined by spaces. leak_passed allows no finding,
    overfit_passed no critical one. risk_level: critical, medium (something suspicious), low (any finding), clean.
    """
    cell = F.struct("index", F.coalesce("source", F.lit("")).alias("source"))
    books = cells.groupBy("path").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    leaks = F.flatten(F.transform("cells", lambda c: leak_findings(c["source"], c["index"])))
    fits = F.flatten(F.transform("cells", lambda c: overfit_findings(c["source"], c["index"])))
    code = F.array_join(F.transform("cells", lambda c: F.lower(c["source"])), " ")
    books = books.select("path", code.alias("code"), leaks.alias("leaks"), fits.alias("fits"), F.array_distinct(F.flatten(F.transform("cells", lambda c: prompts(c["source"])))).alias("prompts"))
    tagged = lambda found, tag: F.exists(found, lambda f: F.contains(f, F.lit(tag)))
    severity = lambda found: F.when(F.size(found) == 0, "info").when(tagged(found, "CRITICAL"), "critical").otherwise("warning")
    both = F.concat("leaks", "fits")
    return books.select(
        "path",
        F.size("leaks").cast("long").alias("n_leaks"),
        (F.size("leaks") == 0).alias("leak_passed"),
        severity(F.col("leaks")).alias("leak_severity"),
        F.size("fits").cast("long").alias("n_fits"),
        (~tagged(F.col("fits"), "CRITICAL")).alias("overfit_passed"),
        severity(F.col("fits")).alias("overfit_severity"),
        F.when(tagged(both, "CRITICAL"), "critical").when(tagged(both, "SUSPICIOUS"), "medium").when(F.size(both) > 0, "low").otherwise("clean").alias("risk_level"),
        first_label(F.col("code"), ARCHITECTURES, "standard_agent").alias("architecture"),
        first_label(F.col("code"), TRAININGS, "prompt_only").alias("training"),
        techniques(F.col("code")).alias("techniques"),
        "prompts",
    )


def decision(improvement: Column, gap: Column, significant: Column, risk_level: Column, improving: Column, beneficial: Column) -> Column:
    """REJECT for critical risk or a gap over 0.2; then ADOPT, PARTIAL_ADOPT or REJECT. beneficial: how many techniques help."""
    return (
        F.when(risk_level == "critical", "REJECT")
        .when(gap > 0.20, "REJECT")
        .when((improvement > 0.05) & significant & (gap < 0.10) & risk_level.isin("clean", "low") & (improving >= 3), "ADOPT")
        .when((improvement > 0.02) & significant & (beneficial > 0), "PARTIAL_ADOPT")
        .otherwise("REJECT")
    )


def fold_comparison(peer: DataFrame, baseline: DataFrame) -> DataFrame:
    """(val_repo, peer, baseline, delta) of fold results (fold_idx, val_repo, resolution_rate), paired by place, the shorter ends it.

    The peer's repository names the row; of folds with one repository the last counts.
    """
    pairs = peer.select("fold_idx", "val_repo", F.col("resolution_rate").alias("peer")).join(baseline.select("fold_idx", F.col("resolution_rate").alias("baseline")), "fold_idx")
    row = F.struct("peer", "baseline", (F.col("peer") - F.col("baseline")).alias("delta"))
    return pairs.groupBy("val_repo").agg(F.max_by(row, "fold_idx").alias("x")).select("val_repo", "x.*")


def beneficial_techniques(rates: DataFrame, base: Column, margin: float = 0.02) -> DataFrame:
    """The rows of (technique, resolution_rate) that are more than margin above the base rate."""
    return rates.where(F.col("resolution_rate") - base > margin)


def bundle_checks(files: DataFrame) -> DataFrame:
    """(bundle, name, passed) of ten checks over the files of each bundle.

    files: (bundle, path within the bundle, length, is_link, content); content is needed of YAML files and adapter configurations,
    null elsewhere. YAML that can't be read fails yaml_schema, in the root's configuration token_limits too; it names no model.
    A bundle's files meet in sums and bounded sets, none is collected.
    """
    path, content = F.col("path"), F.coalesce("content", F.lit(""))
    name = F.substring_index(path, "/", -1)
    low = F.lower(name)
    ext = F.regexp_extract(low, r"[^.](\.[^.]*)$", 1)
    yaml = ext.isin(".yaml", ".yml")
    adapter = F.when(path.rlike(f"^{ADAPTERS}/[^./][^/]*/"), F.regexp_extract(path, f"^{ADAPTERS}/([^/]+)/", 1))
    inside = path.rlike(f"^{ADAPTERS}/[^/]+/[^/]+$")
    rank = F.coalesce(F.nullif(F.get_json_object(content, "$.r"), F.lit("0")), F.get_json_object(content, "$.lora_rank"))
    root = path == ROOT_CONFIG
    facts = yaml_facts(F.when(yaml, content))
    files = files.withColumn("_yaml", facts)
    model, unreadable = F.col("_yaml.model"), yaml & ~F.col("_yaml.readable")
    flag = lambda c: F.max(F.coalesce(c, F.lit(False)))
    bad_limits = root & ~F.col("_yaml.limits_ok")
    parts = files.select(
        "bundle", adapter.alias("adapter"),
        root.alias("root"), F.when(F.col("is_link"), 0).otherwise(F.col("length")).alias("bytes"), ext.isin(FORBIDDEN).alias("forbidden"),
        (inside & (name == ADAPTER_CONFIG)).alias("config"), (inside & (ext == WEIGHTS)).alias("weights"),
        (unreadable | (yaml & F.contains(content, F.lit("..")) & F.contains(content, F.lit("!include")))).alias("climbs"), model.alias("model"),
        F.col("is_link").alias("link"), F.when(inside & (name == ADAPTER_CONFIG), F.when(rank.rlike(r"^\d+$"), rank.cast("decimal(38,0)"))).alias("rank"), bad_limits.alias("bad_limits"),
    )
    each = parts.groupBy("bundle", "adapter").agg(
        flag(F.col("root")).alias("root"), F.sum("bytes").alias("bytes"), flag(F.col("forbidden")).alias("forbidden"), flag(F.col("config")).alias("config"),
        flag(F.col("weights")).alias("weights"), flag(F.col("climbs")).alias("climbs"), F.min("model").alias("least"), F.max("model").alias("most"),
        flag(F.col("link")).alias("link"), F.max("rank").alias("rank"), flag(F.col("bad_limits")).alias("bad_limits"),
    )
    sums = each.groupBy("bundle").agg(
        flag(F.col("root")).alias("root"), F.sum("bytes").alias("bytes"), flag(F.col("forbidden")).alias("forbidden"),
        flag(F.col("adapter").isNotNull() & ~(F.col("config") & F.col("weights"))).alias("incomplete"), flag(F.col("climbs")).alias("climbs"),
        F.min("least").alias("least"), F.max("most").alias("most"), flag(F.col("link")).alias("link"), F.count("adapter").alias("adapters"),
        F.max("rank").alias("rank"), flag(F.col("bad_limits")).alias("bad_limits"),
    )
    checks = {
        "root_config": F.col("root"), "total_size": F.col("bytes") <= MOST_BYTES, "extensions": ~F.col("forbidden"), "adapters": ~F.col("incomplete"), "yaml_schema": ~F.col("climbs"),
        "single_model": F.coalesce(F.col("least") == F.col("most"), F.lit(False)), "no_symlinks": ~F.col("link"), "adapter_count": F.col("adapters") <= MOST_ADAPTERS,
        "lora_rank": F.coalesce(F.col("rank"), F.lit(0)) <= MOST_RANK, "token_limits": F.col("root") & ~F.col("bad_limits"),
    }
    pairs = F.array(*(F.struct(F.lit(k).alias("name"), v.alias("passed")) for k, v in checks.items()))
    return sums.select("bundle", F.explode(pairs).alias("c")).select("bundle", "c.*")


def checkpoint_complete(files: DataFrame, most_bytes: float = 1.5e9) -> DataFrame:
    """(bundle, passed) of checkpoint folders (bundle, path, length): configuration and weights there, no forbidden weights, small enough."""
    ends = lambda *tails: F.max(reduce(lambda a, b: a | b, (F.endswith("path", F.lit(t)) for t in tails)))
    passed = ends(ADAPTER_CONFIG) & ends(WEIGHTS) & ~ends(".bin", ".pt", ".pth") & (F.sum("length") < most_bytes)
    return files.groupBy("bundle").agg(passed.alias("passed"))


def gate(checks: DataFrame) -> None:
    """Raise with the names of the checks that failed. There are few checks."""
    failed = [r.name for r in checks.where("not passed").orderBy("name").select("name").distinct().collect()]
    if failed:
        raise ValueError("failed checks: " + ", ".join(sorted(failed)))
