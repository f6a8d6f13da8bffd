"""Cross-validation results: by fold, over all folds, trends and recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.text import stripped
from quarryline.operators.quantiles import exact_quantiles
from quarryline.session import stored

TIERS = ["SIMPLE", "MODERATE", "COMPLEX"]

# Recommendations in the order that they are given, and the keys under which a reward may stand.
LOW_RATE = "CRITICAL: Resolution rate below 20%. Focus on SFT data quality and tool-call syntax accuracy before RL training."
WEAK_REPO = ("WARNING: Weak repository resolution in ", ". Add more diverse training trajectories for this repo type.")
COMPLEX_GAP = "WARNING: Complex tasks resolve at <30% of simple task rate. Increase multi-file trajectory training and raise tool budget."
TRUNCATION = "WARNING: Truncation rate exceeds 5% threshold. Reduce thinking_budget or split edit_file payloads."
REWARD_KEYS = ["reward", "eval_reward", "mean_reward", "eval_mean_reward", "reward_mean"]
TOOL_USAGE = "WARNING: Average tool usage is high (>60 calls). Add efficiency bonus to RL reward signal."


def share(condition: Column, among: Column | None = None) -> Column:
    """Share of rows that fulfil a condition among those of another; 0 where there are none."""
    among = F.lit(True) if among is None else among
    return F.coalesce(F.avg(F.when(among, condition.cast("double"))), F.lit(0.0))


def budgeted(results: DataFrame, most_calls: int = 100, most_seconds: float = 3600.0) -> DataFrame:
    """results (patch, num_tool_calls, elapsed_seconds) where over budget the patch is null and had_truncation true."""
    over = (F.col("num_tool_calls") > most_calls) | (F.col("elapsed_seconds") > most_seconds)
    return results.withColumns({"patch": F.when(~over, F.col("patch")), "had_truncation": over | F.coalesce("had_truncation", F.lit(False))})


def verified(results: DataFrame) -> DataFrame:
    """resolved and error of results (patch, exit_code, passed, failed, errors; without counts the exit code decides)."""
    empty = stripped(F.coalesce("patch", F.lit(""))) == ""
    ok = F.col("exit_code") == 0
    known = F.col("passed").isNotNull()
    resolved = ~empty & ok & F.when(known, (F.col("passed") > 0) & (F.coalesce("failed", F.lit(0)) == 0) & (F.coalesce("errors", F.lit(0)) == 0)).otherwise(True)
    resolved = F.coalesce(resolved, F.lit(False))
    return results.withColumns({"resolved": resolved, "error": F.when(empty, "No patch generated").when(~resolved, "Tests failed")})


def fold_results(results: DataFrame) -> DataFrame:
    """One row for each fold of results (fold, ord, repo, complexity, resolved, num_tool_calls, tokens, had_truncation).

    val_repo is the repository of the fold's first row; tiers counts tasks by tier, all tiers there.
    """
    first = F.min_by("repo", "ord").alias("val_repo")
    tiers = F.create_map(*(x for t in TIERS for x in (F.lit(t), F.count_if(F.col("complexity") == t))))
    return results.groupBy("fold").agg(
        first, F.count("*").alias("total"), F.count_if("resolved").alias("n_resolved"), share(F.col("resolved")).alias("resolution_rate"),
        F.coalesce(F.avg("num_tool_calls"), F.lit(0.0)).alias("avg_tool_calls"), F.coalesce(F.avg("tokens"), F.lit(0.0)).alias("avg_tokens"),
        share(F.col("had_truncation")).alias("truncation_rate"), tiers.alias("tiers"),
    )


def subset_result(results: DataFrame) -> DataFrame:
    """One row over some results, labelled as mixed."""
    return results.agg(F.lit(-1).alias("fold"), F.lit("mixed").alias("val_repo"), F.count("*").alias("total"), F.count_if("resolved").alias("n_resolved"), share(F.col("resolved")).alias("resolution_rate"))


def report(results: DataFrame) -> DataFrame:
    """One row over all folds: rates, the map of repositories (the last fold of a repository counts) and recommendations in fixed order.

    The rate is that of all tasks; truncation and tool calls are means of folds, each counting once. Folds and their repositories are few.
    """
    # all that is told comes from one pass: sums by fold and tier, a few rows
    sums = stored(results.groupBy("fold", "complexity").agg(
        F.min(F.struct("ord", "repo")).alias("first"), F.count("*").alias("n"), F.count("resolved").alias("known"), F.count_if("resolved").alias("hits"),
        F.count("had_truncation").alias("told"), F.count_if("had_truncation").alias("cut"), F.count("num_tool_calls").alias("used"), F.sum("num_tool_calls").alias("calls"),
    ), "sums")
    ratio = lambda a, b: F.coalesce(F.try_divide(F.sum(a).cast("double"), F.sum(b)), F.lit(0.0))
    folds = sums.groupBy("fold").agg(F.min("first").alias("first"), ratio("hits", "known").alias("resolution_rate"), ratio("cut", "told").alias("truncation_rate"), ratio("calls", "used").alias("avg_tool_calls"))
    folds = folds.withColumn("val_repo", F.col("first.repo"))
    entries = folds.groupBy("val_repo").agg(F.max_by("resolution_rate", "fold").alias("rate"), F.min("fold").alias("place"))
    repos = entries.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("val_repo", "rate")))).alias("per_repo"), F.min(F.struct("rate", "place", "val_repo")).alias("weak"))
    means = folds.agg(F.coalesce(F.avg("truncation_rate"), F.lit(0.0)).alias("t"), F.coalesce(F.avg("avg_tool_calls"), F.lit(0.0)).alias("u"), F.count("*").alias("n_folds"))
    of = lambda t, c: F.when(F.col("complexity") == t, F.col(c))
    rates = [ratio(of(t, "hits"), of(t, "known")).alias(t.lower()) for t in TIERS]
    whole = sums.agg(ratio("hits", "known").alias("rate"), *rates).crossJoin(F.broadcast(repos)).crossJoin(F.broadcast(means))  # one row each
    advice = F.array(
        F.when(F.col("rate") < 0.20, LOW_RATE),
        F.when(F.col("weak.rate") < 0.5 * F.col("rate"), F.concat(F.lit(WEAK_REPO[0]), F.col("weak.val_repo"), F.lit(WEAK_REPO[1]))),
        F.when(F.col("complex") < 0.3 * F.col("simple"), COMPLEX_GAP),
        F.when(F.col("t") > 0.05, TRUNCATION),
        F.when(F.col("u") > 60, TOOL_USAGE),
    )
    return whole.select(F.col("rate").alias("resolution_rate"), *(t.lower() for t in TIERS), "per_repo", "n_folds", F.array_compact(advice).alias("recommendations"))


def tiers_of_folds(tasks: DataFrame, folds: DataFrame) -> DataFrame:
    """(fold, SIMPLE, MODERATE, COMPLEX): tasks (instance_id, complexity) of each fold (instance_id, fold) by tier, 0 where there are none."""
    return tasks.join(folds, "instance_id").groupBy("fold").agg(*(F.count_if(F.col("complexity") == t).alias(t) for t in TIERS))


def reward_of(metrics: Column, keys: tuple[str, ...] = tuple(REWARD_KEYS)) -> Column:
    """The first number among some keys of a map of texts."""
    return F.coalesce(*(F.try_element_at(metrics, F.lit(k)).try_cast("double") for k in keys))


def nudges(turns: DataFrame, most: int = 3) -> DataFrame:
    """(conv_id, turn, run, stops): consecutive model turns without a tool call; a call starts anew; more than most stop."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    blocks = turns.withColumn("block", F.count_if("has_call").over(w))
    run = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn"))
    rows = blocks.withColumn("run", F.when(F.col("block") > 0, run - 1).otherwise(run))
    return rows.select("conv_id", "turn", F.col("run").cast("long").alias("run"), (F.col("run") > most).alias("stops"))


def compacted(turns: DataFrame, limit: int = 14336, retain: int = 5) -> DataFrame:
    """(conv_id, turn, kept): where a conversation's tokens exceed limit, only its first and its last retain turns stay as they are."""
    whole = Window.partitionBy("conv_id")
    place = F.row_number().over(whole.orderBy("turn"))  # one order for both ends: sorts of one partition would be held at once
    rows = turns.select("conv_id", "turn", "tokens", place.alias("place"))
    rows = rows.select("conv_id", "turn", "place", F.sum("tokens").over(whole).alias("total"), F.count("*").over(whole).alias("n"))
    return rows.select("conv_id", "turn", ((F.col("total") <= limit) | (F.col("place") > F.col("n") - retain) | (F.col("place") == 1)).alias("kept"))


def nearest_to_median(df: DataFrame, value: str, key: str) -> DataFrame:
    """The row whose value lies next to the exact median, the smallest key of equal ones; no task holds all values."""
    middle = F.broadcast(exact_quantiles(df, [], value, [0.5]).select(F.col("quantile").alias("median")))  # one row
    return df.crossJoin(middle).orderBy(F.abs(F.col(value) - F.col("median")), key).limit(1)
