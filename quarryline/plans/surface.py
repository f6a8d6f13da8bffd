"""Queries with functions of one's own: permutation tests, mergeable aggregates, scorers, compaction and streams with late rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import scorers
from quarryline.functions.text import token_estimate
from quarryline.operators import context, mergeable, significance
from quarryline.session import shared_folder, sql, table
from quarryline.streaming import telemetry


def agg_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the quality of labelled documents better in one third (ids divisible by three) than in the rest: by permutations."""
    out = significance.permutation_test(table(spark, sf_dir, "labels"), "doc_id", "quality", F.col("doc_id") % 3 == 0)
    return out.select("n_treated", "n_control", F.round("difference", 9).alias("difference"))


def agg_permutation_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Are English documents longer than others; p from ten thousand permutations of all lengths."""
    return significance.permutation_test(table(spark, sf_dir, "documents"), "doc_id", "n_chars", F.col("lang") == "en")


def agg_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of prices by flag and status, by an aggregate of one's own."""
    out = mergeable.aggregated(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_extendedprice"], mergeable.Moments())
    return out.select("l_returnflag", "l_linestatus", "n", F.round("mean", 4).alias("mean"), F.round(F.sqrt("variance"), 4).alias("deviation"), F.round("skewness", 6).alias("skewness"))


def score_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scores for each turn, whose calls are made of its text."""
    scorers.register_scorers(spark, "turn_scores", {"syntax": scorers.call_syntax, "brevity": scorers.brevity(200)})
    turns = """SELECT conv_id, turn, text || CASE turn % 3 WHEN 0 THEN '<tool_call>{"k": ' || CAST(conv_id AS STRING) || '}</tool_call><tool_call>{k}</tool_call>' WHEN 1 THEN '<tool_call>[1]</tool_call>' ELSE '' END AS text FROM conversations"""
    return sql(spark, sf_dir, f"SELECT conv_id, turn, s.scorer, round(s.score, 9) AS score FROM ({turns}) t, LATERAL turn_scores(t.text) s")


def win_compactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summaries of conversations of at most 300 tokens, every third turn, one turn read again, two left as they are."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", token_estimate(F.col("text")).alias("tokens"))
    return context.compactions(rows, 3, 1, 300, 2)


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of a stream whose older half comes last, in a third batch: what is later than two days is left out."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(second), F.max(second)).first()
    fresh = second >= (low + high) // 2
    even = F.coalesce(F.col("event_id") % 2 == 0, F.lit(False))  # all other ids come second, also negative and missing ones
    folder = f"{shared_folder(spark)}/arrivals-{uuid.uuid4().hex}"
    parts = [events.where(fresh & even), events.where(fresh & ~even), events.where(~fresh)]
    if parts[0].isEmpty():  # nothing tells what is late, so by the SQL nothing old counts
        parts.pop()
    parts[0].write.parquet(folder)
    arrivals = [lambda part=part: part.write.mode("append").parquet(folder) for part in parts[1:]]
    arriving = spark.readStream.schema(events.schema).parquet(folder)
    return telemetry.drained(telemetry.windowed_counts(arriving, late="2 days"), "append", arrivals)


QUERIES = {f.__name__: f for f in (agg_permutation, agg_permutation_lengths, agg_moments, score_turns, win_compactions, stream_late)}

ORACLE = {
    "agg_permutation": "SELECT count(*) FILTER (doc_id % 3 = 0) AS n_treated, count(*) FILTER (doc_id % 3 <> 0) AS n_control, round(avg(quality) FILTER (doc_id % 3 = 0) - avg(quality) FILTER (doc_id % 3 <> 0), 9) AS difference FROM labels",
    "agg_moments": """
        WITH m AS (SELECT l_returnflag, l_linestatus, avg(l_extendedprice) AS mean FROM lineitem GROUP BY ALL)
        SELECT l_returnflag, l_linestatus, count(*) AS n, round(any_value(mean), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS deviation, round(avg((l_extendedprice - mean) ** 3) / stddev_pop(l_extendedprice) ** 3, 6) AS skewness
        FROM lineitem JOIN m USING (l_returnflag, l_linestatus) GROUP BY ALL""",
    "score_turns": """
        WITH t AS (SELECT conv_id, turn, length(text) + CASE turn % 3 WHEN 0 THEN length('<tool_call>{"k": ' || conv_id || '}</tool_call><tool_call>{k}</tool_call>') WHEN 1 THEN length('<tool_call>[1]</tool_call>') ELSE 0 END AS n FROM conversations)
        SELECT conv_id, turn, 'syntax' AS scorer, CASE turn % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 END AS score FROM t UNION ALL SELECT conv_id, turn, 'brevity', round(least(1.0, 200 / greatest(1, n)), 9) FROM t""",
    "win_compactions": """
        WITH RECURSIVE r AS (SELECT conv_id, turn, row_number() OVER w AS k, sum(CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, ceil(length(text) / 4.0)) END) OVER w AS total FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
             s AS (SELECT conv_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS done, CAST(0 AS BIGINT) AS no, CAST(NULL AS VARCHAR) AS cause, CAST(0 AS BIGINT) AS first FROM r WHERE k = 1
                   UNION ALL
                   SELECT conv_id, k, CASE cause WHEN 'threshold' THEN k - 2 WHEN 'interval' THEN k ELSE done END, no + CASE WHEN cause IS NULL THEN 0 ELSE 1 END, cause, CASE WHEN no = 0 THEN 1 ELSE greatest(1, done) END
                   FROM (SELECT s.conv_id, r.k, s.done, s.no, CASE WHEN r.total - coalesce(d.total, 0) > 300 AND r.k - s.done > 2 THEN 'threshold' WHEN r.k - s.done >= 3 THEN 'interval' END AS cause
                         FROM s JOIN r ON r.conv_id = s.conv_id AND r.k = s.k + 1 LEFT JOIN r d ON d.conv_id = s.conv_id AND d.k = s.done) x)
        SELECT s.conv_id, no, r.turn AS at_turn, f.turn AS first_turn, l.turn AS last_turn, cause, CAST(r.total - l.total AS BIGINT) AS live
        FROM s JOIN r ON r.conv_id = s.conv_id AND r.k = s.k JOIN r f ON f.conv_id = s.conv_id AND f.k = s.first JOIN r l ON l.conv_id = s.conv_id AND l.k = s.done WHERE cause IS NOT NULL""",
    "stream_late": """
        WITH m AS (SELECT (floor(min(epoch(ts))) + floor(max(epoch(ts)))) // 2 AS middle FROM events), e AS (SELECT *, floor(epoch(ts)) >= middle AS fresh, date_trunc('hour', ts) AS start FROM events, m),
             w AS (SELECT max(ts) FILTER (fresh AND event_id % 2 = 0) - INTERVAL 2 DAY AS late, max(ts) - INTERVAL 2 DAY AS closed FROM e)
        SELECT start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM e, w WHERE (fresh OR start + INTERVAL 1 HOUR > late) AND start + INTERVAL 1 HOUR <= closed GROUP BY start, event_type""",
}
