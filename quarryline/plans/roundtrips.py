"""Queries through sources and sinks: tables written in the forms that the readers know, read back and reported."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators import diffs, inspection, trajectories
from quarryline.session import shared_folder, sql, table
from quarryline.sources import archives, readers, sinks
from quarryline.streaming import telemetry


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def src_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks from JSON lines with missing fields, nulls, unknown keys and times of both kinds."""
    path = _folder(spark, "tasks")
    rows = sql(spark, sf_dir, """
        SELECT '{"instance_id": "' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS STRING) || '"' || CASE p_partkey % 3 WHEN 0 THEN ', "repo": "own/' || p_brand || '"' WHEN 1 THEN ', "repo": null' ELSE '' END
               || ', "created_at": "' || CASE WHEN p_partkey % 2 = 0 THEN '2024-05-06T01:02:03Z' ELSE 'soon' END || '", "more": [1, 2], "patch": "a\\\\nb"}' || CASE WHEN p_partkey % 7 = 0 THEN chr(10) ELSE '' END AS value FROM part""")
    rows.write.text(path)
    return readers.described_tasks(spark, path).select("instance_id", "repo", "patch", "hints_text", F.unix_seconds("created_ts").alias("created"))


def src_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of code graphs, one JSON text a supplier, written as objects, pairs or an object by source."""
    path = _folder(spark, "graphs")
    parts = sql(spark, sf_dir, "SELECT DISTINCT l_suppkey AS s, CAST(l_partkey AS STRING) AS p FROM lineitem WHERE l_quantity > 45").groupBy("s").agg(F.sort_array(F.collect_list("p")).alias("p"))
    text = lambda f: F.array_join(F.transform("p", f), ", ")
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    root = quoted(F.col("s").cast("string"))
    nodes = F.concat(F.lit('{"nodes": [{"id": '), root, F.lit("}, "), text(lambda x: F.concat(F.lit('{"id": '), quoted(x), F.lit("}"))), F.lit('], "'))
    objects = F.concat(F.lit('edges": ['), text(lambda x: F.concat(F.lit('{"source": '), root, F.lit(', "dst": '), quoted(x), F.lit(', "type": "HAS"}'))), F.lit("]}"))
    pairs = F.concat(F.lit('links": ['), text(lambda x: F.concat(F.lit("["), root, F.lit(", "), quoted(x), F.lit("]"))), F.lit("]}"))
    keyed = F.concat(F.lit('edges": {'), root, F.lit(": ["), text(quoted), F.lit("]}}"))
    whole = F.concat(nodes, F.when(F.col("s") % 3 == 0, objects).when(F.col("s") % 3 == 1, pairs).otherwise(keyed))
    parts.select("s", whole.alias("value")).write.partitionBy("s").text(path)
    nodes, edges, _ = archives.any_graphs(spark, f"{path}/s=*")
    known = nodes.select(F.col("id").alias("source")).distinct()
    counts = edges.join(known, "source").groupBy("source").agg(F.count("*").alias("n_edges"), F.count_distinct("target").alias("n_targets"), F.count("type").alias("n_typed"))
    return counts.select(F.col("source").cast("long").alias("s"), "n_edges", "n_targets", "n_typed")


def src_notebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of notebooks, a source a string or a list of strings: their kinds and whole texts."""
    path = _folder(spark, "notebooks")
    docs = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 50).alias("book"), "doc_id", "text")
    listed = F.transform(F.split("text", "(?<=\n)"), lambda x: x)
    one = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(F.lit("code").alias("cell_type"), F.col("text").alias("source")))).otherwise(F.to_json(F.struct(F.lit("markdown").alias("cell_type"), listed.alias("source"))))
    books = docs.groupBy("book").agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", one.alias("c")))), lambda x: x["c"]).alias("cells"))  # fifty cells a notebook
    books.select("book", F.concat(F.lit('{"cells": ['), F.array_join("cells", ","), F.lit("]}")).alias("value")).write.partitionBy("book").text(path)
    cells = readers.notebook_cells(spark, f"{path}/book=*")
    return cells.select((F.regexp_extract("path", "book=([0-9]+)", 1).cast("long") * 50 + F.col("index")).alias("doc_id"), "cell_type", F.sha2("source", 256).alias("text_sha"))


def src_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder tree by ending, and how many lines those of one ending have."""
    path = _folder(spark, "texts")
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", F.concat(F.lit("line "), F.col("doc_id").cast("string")).alias("value"))
    docs.repartition(1).select("lang", "value").write.partitionBy("lang").option("compression", "none").text(path)
    files = readers.inventory(spark, path).where("ext = '.txt'")
    lines = readers.texts(spark, path, [".txt"]).select(F.regexp_extract("path", "lang=([a-z]+)", 1).alias("lang"), F.size(F.split(F.rtrim(F.regexp_replace("text", "\n$", "")), "\n")).cast("long").alias("n_lines"))
    sizes = files.select(F.regexp_extract("path", "lang=([a-z]+)", 1).alias("lang"), "length")
    return sizes.groupBy("lang").agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes")).join(lines.groupBy("lang").agg(F.sum("n_lines").alias("n_lines")), "lang")


def src_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves of YAML texts with nested mappings and lists; every eleventh can't be read."""
    rows = sql(spark, sf_dir, """
        SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 0 THEN 'key: [unclosed' ELSE 'name: ' || p_name || chr(10) || 'train:' || chr(10) || '  rate: ' || CAST(p_size AS STRING) || chr(10) || '  steps: [' || CAST(p_size AS STRING) || ', ' || p_brand || ']' || chr(10)
               || 'none: null' || chr(10) || 'prompt: !include ' || p_type || '.md' || chr(10) END AS text FROM part""")
    return readers.yaml_leaves(rows, "id", "text").withColumn("error", F.col("error").isNotNull())


def snk_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of the days' events as one JSON text in order."""
    days = sql(spark, sf_dir, "SELECT substr(CAST(ts AS STRING), 1, 10) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
    return sinks.history_json(days, "day")


def pref_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rollouts of one task whose scores lie more than the margin apart."""
    rows = sql(spark, sf_dir, "SELECT l_orderkey AS instance_id, l_linenumber * 1000000 + l_partkey AS gen, max(l_discount) * 10 AS score FROM lineitem GROUP BY 1, 2")
    out = trajectories.preference_pairs(rows)
    return out.select("instance_id", "chosen", "rejected", F.round("chosen_score", 9).alias("chosen_score"), F.round("rejected_score", 9).alias("rejected_score"))


def snk_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's artefacts, written and read back: its summary, and its patches and traces by instance."""
    path = _folder(spark, "results")
    rows = sql(spark, sf_dir, "SELECT CAST(p_partkey AS STRING) AS instance_id, p_size > 25 AS resolved, CASE WHEN p_partkey % 3 <> 0 THEN 'diff ' || p_name END AS patch, CASE WHEN p_partkey % 5 = 0 THEN 'log' END AS trace FROM part")
    sinks.write_results(rows, path)
    summary = spark.read.json(f"{path}/summary").select(F.lit("summary").alias("kind"), F.col("total").alias("n"), F.round("resolution_rate", 9).alias("rate"))
    count = lambda name: spark.read.json(f"{path}/{name}").agg(F.lit(name).alias("kind"), F.count("*").alias("n"), F.round(F.avg(F.col("instance_id").cast("long")), 6).alias("rate"))
    return summary.unionByName(count("patches")).unionByName(count("traces")).unionByName(count("task_results"))


def snk_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as a submission, read back: blank and missing ones say so."""
    path = _folder(spark, "submission")
    rows = sql(spark, sf_dir, "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'diff ' || p_name END AS prediction FROM part")
    sinks.write_submission(rows, path)
    return spark.read.parquet(path)


def snk_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with updates, of which a key may have several, and rows that lack columns."""
    rows = sql(spark, sf_dir, "SELECT p_partkey AS id, p_name AS name, p_size AS score FROM part")
    news = sql(spark, sf_dir, "SELECT s_suppkey AS id, s_nationkey + 100 AS score FROM supplier UNION ALL SELECT s_suppkey, 50 FROM supplier UNION ALL SELECT s_suppkey + 100000000, 1 FROM supplier")
    added = sql(spark, sf_dir, "SELECT n_nationkey - 1000 AS id, n_name AS name FROM nation")
    out = sinks.append_registry(sinks.update_registry(rows, news, "id"), added)
    return out.select(F.col("id").cast("long").alias("id"), "name", F.col("score").cast("long").alias("score"))


def snk_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events logged as telemetry and read back as JSON: counts and payload sums by kind."""
    path = _folder(spark, "telemetry")
    events = table(spark, sf_dir, "events")
    for kind, condition in (("metric", "event_type = 'click'"), ("info", "event_type <> 'click'")):
        sinks.append_telemetry(events.where(condition).select(*sinks.telemetry_event(kind, "v1.2.3", F.struct("user_id", "value"), F.col("ts").cast("timestamp"))), path)
    back = spark.read.schema("timestamp string, run_version string, event_type string, payload string").json(path)
    user = F.get_json_object("payload", "$.user_id").cast("long")
    return back.groupBy("event_type", "run_version").agg(F.count("*").alias("n"), F.sum(user).alias("users"), F.min("timestamp").alias("first"))


def edit_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits of a text by string: as it stands, with other white space, word by word, twice there, not there."""
    rows = sql(spark, sf_dir, """
        SELECT p_partkey AS id, 'def f(x):' || chr(10) || '    return ' || p_type || ' + ' || CAST(p_size AS STRING) || chr(10) || CASE WHEN p_partkey % 5 = 3 THEN '    return ' || p_type || ' + ' || CAST(p_size AS STRING) || chr(10) ELSE '' END AS source,
               CASE p_partkey % 5 WHEN 1 THEN 'return   ' || p_type || chr(9) || '+ ' || CAST(p_size AS STRING) || chr(10) WHEN 2 THEN 'return ' || p_type || '+' || CAST(p_size AS STRING) WHEN 4 THEN 'return nothing' ELSE 'return ' || p_type || ' + ' || CAST(p_size AS STRING) END AS old, 'return 1' AS new FROM part""")
    return diffs.apply_edits(rows).select("id", "how", F.sha2("result", 256).alias("result_sha"))


def chk_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which checkpoint folders are whole."""
    files = sql(spark, sf_dir, """
        SELECT CAST(floor(p_partkey / 4.0D) AS BIGINT) AS bundle, CASE p_partkey % 4 WHEN 0 THEN 'adapter_config.json' WHEN 1 THEN CASE WHEN p_size % 7 = 0 THEN 'x.txt' ELSE 'w.safetensors' END WHEN 2 THEN CASE WHEN p_size % 9 = 0 THEN 'old.bin' ELSE 'readme.md' END ELSE 'log.txt' END AS path,
               CAST(p_size AS BIGINT) * 20000000 AS length FROM part""")
    return inspection.checkpoint_complete(files)


def stream_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that users have left after a stream of their events; free ones do not count."""
    status = telemetry.budget_status(telemetry.read_events(spark, f"{sf_dir}/events*.parquet"), most=60)
    return telemetry.drained(status, "update")


def stream_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early stopping of runs in a stream: each user's values in order of their events."""
    metrics = telemetry.read_events(spark, f"{sf_dir}/events*.parquet").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "value")
    return telemetry.drained(telemetry.stops(metrics, 0.01, 3), "update").select("run", F.round("best", 6).alias("best"), "waited", "stopped")


QUERIES = {
    f.__name__: f
    for f in (src_tasks, src_graphs, src_notebooks, src_texts, src_yaml, snk_history, pref_rollouts, snk_results, snk_submission, snk_registry, snk_telemetry, edit_strings, chk_checkpoints, stream_budget, stream_stops)
}

_EDIT = "'def f(x):' || chr(10) || '    return 1'"
ORACLE = {
    "src_tasks": """
        SELECT replace(p_name, ' ', '_') || '_' || p_partkey AS instance_id, CASE WHEN p_partkey % 3 = 0 THEN 'own/' || p_brand ELSE replace(p_name, ' ', '_') END AS repo, 'a' || chr(10) || 'b' AS patch, '' AS hints_text,
               CASE WHEN p_partkey % 2 = 0 THEN CAST(epoch(TIMESTAMP '2024-05-06 01:02:03') AS BIGINT) END AS created FROM part""",
    "src_graphs": "SELECT l_suppkey AS s, count(DISTINCT l_partkey) AS n_edges, count(DISTINCT l_partkey) AS n_targets, CASE WHEN l_suppkey % 3 = 0 THEN count(DISTINCT l_partkey) ELSE 0 END AS n_typed FROM lineitem WHERE l_quantity > 45 GROUP BY l_suppkey",
    "src_notebooks": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'code' ELSE 'markdown' END AS cell_type, sha256(text) AS text_sha FROM documents",
    "src_texts": "SELECT lang, CAST(1 AS BIGINT) AS n_files, CAST(sum(length('line ' || doc_id) + 1) AS BIGINT) AS bytes, count(*) AS n_lines FROM documents GROUP BY lang",
    "src_yaml": """
        WITH g AS (SELECT * FROM part WHERE p_partkey % 11 <> 0)
        SELECT p_partkey AS id, '/name' AS path, 'name' AS name, p_name AS value, FALSE AS error FROM g UNION ALL SELECT p_partkey, '/train/rate', 'rate', CAST(p_size AS VARCHAR), FALSE FROM g UNION ALL SELECT p_partkey, '/train/steps/0', '0', CAST(p_size AS VARCHAR), FALSE FROM g
        UNION ALL SELECT p_partkey, '/train/steps/1', '1', p_brand, FALSE FROM g UNION ALL SELECT p_partkey, '/none', 'none', NULL, FALSE FROM g UNION ALL SELECT p_partkey, '/prompt', 'prompt', p_type || '.md', FALSE FROM g
        UNION ALL SELECT p_partkey, NULL, NULL, NULL, TRUE FROM part WHERE p_partkey % 11 = 0""",
    "snk_history": """
        SELECT '[' || string_agg('{"day":"' || day || '","n":' || n || ',"users":' || users || '}', ',' ORDER BY day) || ']' AS json FROM (SELECT substr(CAST(ts AS VARCHAR), 1, 10) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1) d""",
    "pref_rollouts": """
        WITH s AS (SELECT l_orderkey AS instance_id, l_linenumber * 1000000 + l_partkey AS gen, max(l_discount) * 10 AS score FROM lineitem GROUP BY 1, 2)
        SELECT a.instance_id, a.gen AS chosen, b.gen AS rejected, round(a.score, 9) AS chosen_score, round(b.score, 9) AS rejected_score FROM s a JOIN s b ON a.instance_id = b.instance_id AND a.score - b.score > 0.3""",
    "snk_results": """
        SELECT 'summary' AS kind, count(*) AS n, round(avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END), 9) AS rate FROM part UNION ALL SELECT 'patches', count(*), round(avg(p_partkey), 6) FROM part WHERE p_partkey % 3 <> 0
        UNION ALL SELECT 'traces', count(*), round(avg(p_partkey), 6) FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT 'task_results', count(*), round(avg(p_partkey), 6) FROM part""",
    "snk_submission": "SELECT p_partkey AS id, CASE WHEN p_partkey % 4 < 2 THEN 'NO_PATCH' ELSE 'diff ' || p_name END AS prediction FROM part",
    "snk_registry": """
        SELECT p_partkey AS id, p_name AS name, CAST(CASE WHEN s_suppkey IS NULL THEN p_size ELSE greatest(s_nationkey + 100, 50) END AS BIGINT) AS score FROM part LEFT JOIN supplier ON s_suppkey = p_partkey UNION ALL SELECT n_nationkey - 1000, n_name, NULL FROM nation""",
    "snk_telemetry": """
        SELECT CASE WHEN event_type = 'click' THEN 'metric' ELSE 'info' END AS event_type, 'v1.2.3' AS run_version, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS first FROM events GROUP BY 1""",
    "edit_strings": f"""
        SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 1 THEN 'spaces' WHEN 2 THEN 'tokens' WHEN 3 THEN 'ambiguous' WHEN 4 THEN 'missing' ELSE 'exact' END AS how, CASE WHEN p_partkey % 5 < 3 THEN sha256({_EDIT} || chr(10)) END AS result_sha FROM part""",
    "chk_checkpoints": """
        SELECT p_partkey // 4 AS bundle, bool_or(p_partkey % 4 = 0) AND bool_or(p_partkey % 4 = 1 AND p_size % 7 <> 0) AND NOT bool_or(p_partkey % 4 = 2 AND p_size % 9 = 0) AND sum(p_size) * 20000000 < 1500000000 AS passed FROM part GROUP BY 1""",
    "stream_budget": """
        WITH u AS (SELECT user_id, count(*) FILTER (event_type <> 'signup') AS used FROM events GROUP BY user_id) SELECT user_id, used, greatest(0, 60 - used) AS remaining, used >= 20 AND 60 - used <= 10 AS warns FROM u""",
    "stream_stops": """
        WITH RECURSIVE d AS (SELECT user_id AS run, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
             s AS (SELECT DISTINCT run, CAST(0 AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS best, CAST(0 AS BIGINT) AS waited, FALSE AS stopped FROM d
                   UNION ALL SELECT s.run, d.k, CASE WHEN best IS NULL OR v >= best + 0.01 THEN v ELSE best END, CASE WHEN best IS NULL OR v >= best + 0.01 THEN 0 ELSE waited + 1 END, NOT (best IS NULL OR v >= best + 0.01) AND waited + 1 >= 3
                   FROM s JOIN d ON d.run = s.run AND d.k = s.k + 1 WHERE NOT stopped)
        SELECT run, round(arg_max(best, k), 6) AS best, arg_max(waited, k) AS waited, arg_max(stopped, k) AS stopped FROM s GROUP BY run""",
}
