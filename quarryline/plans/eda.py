"""Queries on patches, issue texts, ranked paths, graphs, vectors, scalars and windows of events, each with DuckDB SQL written by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import text
from quarryline.operators import diffs, inspection, retrieval
from quarryline.plans.dialect import SPARK
from quarryline.session import sql, table
from quarryline.sources import readers
from quarryline.streaming import telemetry


def true_patches(d) -> str:
    """One patch per order whose headers state the true counts, but for every tenth order; files are added, deleted or changed."""
    line = "CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE ' ' END || CASE WHEN l_linenumber % 2 = 0 THEN 'def f_' || CAST(l_partkey AS STRING) || '():' ELSE 'x' END"
    body = d.agg(line, "chr(10)", "l_linenumber, l_partkey, l_suppkey, l_extendedprice")
    return f"""
    files AS (SELECT l_orderkey AS id, CASE WHEN CAST(substr(p_brand, 7, 2) AS INT) % 4 = 0 THEN 'tests/' WHEN CAST(substr(p_brand, 7, 2) AS INT) % 6 = 1 THEN 'src/debug_' ELSE 'src/' END || p_brand || '.py' AS path, (l_orderkey + CAST(substr(p_brand, 7, 2) AS INT)) % 5 AS st,
                     sum(CASE WHEN l_returnflag <> 'A' THEN 1 ELSE 0 END) AS n_old, sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) + CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 0 END AS n_new, {body} AS body
              FROM {d.gathered('lineitem JOIN part ON l_partkey = p_partkey', 'l_orderkey')} GROUP BY l_orderkey, p_brand),
    blocks AS (SELECT id, path, 'diff --git a/' || path || ' b/' || path || chr(10) || '--- ' || CASE WHEN st = 0 THEN '/dev/null' ELSE 'a/' || path END || chr(10) || '+++ ' || CASE WHEN st = 1 THEN '/dev/null' ELSE 'b/' || path END || chr(10)
                      || '@@ -1,' || CAST(n_old AS STRING) || ' +1,' || CAST(n_new AS STRING) || ' @@' || chr(10) || body AS block FROM files),
    patches AS (SELECT id, {d.agg("block", "chr(10)", "path")} AS patch FROM blocks GROUP BY id)"""


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, f"WITH {true_patches(SPARK)} SELECT id, patch FROM patches")
    return diffs.parse_counted(rows, "id", "patch")


def task_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = diffs.features(counted(spark, sf_dir))
    return rows.select("id", "n_files", F.size("gold_files").cast("long").alias("n_src_files"), F.size("gold_symbols").cast("long").alias("n_symbols"), "n_hunks", "added", "deleted", "churn", "adds_new_file", "patch_ok")


def diff_hunk_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir).select("id", F.explode("files").alias("f")).select("id", "f.path", "f.added", "f.deleted", "f.hunks", "f.status")


def patch_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each kind of finding occurs: the message up to its colon. Every seventeenth patch is blank."""
    patches = sql(spark, sf_dir, f"WITH {true_patches(SPARK)} SELECT id, CASE WHEN id % 17 = 0 THEN ' ' || chr(10) ELSE patch END AS patch FROM patches")
    rows = diffs.findings(diffs.parse_counted(patches, "id", "patch", kept=True), F.col("patch"), 6).select(F.explode("findings").alias("f"))
    kind = F.regexp_replace(F.substring_index("f.message", ":", 1), r"\(\d+ changed lines\)", "(n changed lines)")
    return rows.groupBy("f.severity", kind.alias("kind")).agg(F.count("*").alias("n"))


def diff_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, f"WITH {true_patches(SPARK)} SELECT id, patch FROM patches")
    return rows.select("id", F.explode(diffs.old_files(F.col("patch"))).alias("path"))


def diff_new_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, "SELECT p_partkey AS id, '+def test_' || replace(p_name, ' ', '_') || '():' || chr(10) || '+  async def test_b' || CAST(p_size AS STRING) || '(x)' || chr(10) || ' def test_c()' || chr(10) || '-def test_d()' AS patch FROM part")
    return rows.select("id", F.array_join(diffs.new_tests(F.col("patch")), ",").alias("tests"))


PATH_NEEDLES, STEM_NEEDLES, SYMBOL_NEEDLES = ["src/main.py", "license"], ["token", "mit"], ["the", "ab", "to", "und"]


def issue_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What texts say of a place in the code, and the share of each sign by language and in all."""
    docs = sql(spark, sf_dir, "SELECT doc_id, lang, text || CASE doc_id % 17 WHEN 1 THEN ' Traceback (most recent call last): x' WHEN 2 THEN ' ```x``` src/main.py' WHEN 3 THEN chr(10) || '    code' WHEN 4 THEN ' xab abx ab_ /ab' ELSE '' END AS text, CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE 'hint' END AS hints FROM documents")
    t = F.col("text")
    says = lambda needles: text.mentioned(t, F.lit(needles))
    rows = docs.select(
        "doc_id", "lang", says(PATH_NEEDLES).alias("path"), says(STEM_NEEDLES).alias("module"), says(SYMBOL_NEEDLES).alias("symbol"), F.contains(t, F.lit("Traceback (most recent call last)")).alias("traceback"),
        (F.contains(t, F.lit("```")) | F.contains(t, F.lit("\n    "))).alias("code"), (text.stripped(F.col("hints")) != "").alias("hinted"),
    )
    rows = rows.withColumn("any_place", F.col("path") | F.col("module") | F.col("symbol") | F.col("traceback"))
    signs = ["path", "module", "symbol", "traceback", "code", "hinted", "any_place"]
    return rows.rollup("lang").agg(F.count("*").alias("n"), *(F.round(F.avg(F.col(s).cast("double")), 9).alias(s) for s in signs))


RANKED = "SELECT page_id % 40 AS task, path, row_number() OVER (PARTITION BY page_id % 40 ORDER BY page_id DESC) AS k, page_id FROM (SELECT page_id, regexp_extract(url, '://[^/]*/([^?#]*)', 1) AS path FROM pages) a"


def path_gold_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = sql(spark, sf_dir, RANKED)
    gold = ranked.where("page_id % 50 = 0 and path <> ''").select("task", F.element_at(F.split("path", "/"), -1).alias("path")).where("path <> ''")
    return retrieval.gold_rank(ranked.where("path <> ''").select("task", "path", "k"), gold)


def path_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = path_gold_rank(spark, sf_dir)
    tasks = sql(spark, sf_dir, "SELECT DISTINCT page_id % 40 AS task FROM pages")
    rows = tasks.join(ranks, "task", "left").select(F.concat(F.lit("repo_"), (F.col("task") % 3).cast("string")).alias("repo"), "rank")
    out = retrieval.hits(rows, "repo")
    return out.select("repo", "tasks", *(F.round(c, 9).alias(c) for c in ("hit1", "hit5", "hit10", "mrr")))


NODES = "SELECT p_partkey AS k, p_brand || '/mod' || CAST(p_partkey AS STRING) || '.' || replace(p_type, ' ', '_') || '#' || CAST(p_size AS STRING) AS id, p_name AS name FROM part"


def graph_symbol_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = sql(spark, sf_dir, "SELECT DISTINCT CAST(p_size AS STRING) AS symbol FROM part WHERE p_size < 6 UNION ALL SELECT p_name FROM part WHERE p_partkey % 50 = 0")
    rows = retrieval.symbol_nodes(sql(spark, sf_dir, NODES).select("id", "name"), symbols)
    return rows.select("id", "name", retrieval.node_tail(F.col("id")).alias("tail"), retrieval.node_label(F.col("id")).alias("label"))


def graph_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sql(spark, sf_dir, f"SELECT DISTINCT CASE k % 5 WHEN 0 THEN id WHEN 1 THEN substr(id, 10) WHEN 2 THEN upper(id) WHEN 3 THEN substr(id, 3, 9) ELSE 'nowhere' END AS name FROM ({NODES}) a")
    return retrieval.resolved(names, sql(spark, sf_dir, NODES).select("id"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges written under four sets of names, made one for each pair of nodes, and how many each graph has."""
    rows = sql(spark, sf_dir, "SELECT l_suppkey % 5 AS graph, l_linenumber % 4 AS style, CAST(l_suppkey AS STRING) AS s, CAST(l_partkey AS STRING) AS t, l_returnflag AS kind FROM lineitem")
    maps = [F.create_map(F.lit(a), F.col("s"), F.lit(b), F.col("t"), F.lit(c), F.col("kind")) for a, b, c in (("source", "target", "type"), ("src", "dst", "kind"), ("caller", "callee", "edge_type"), ("u", "v", "weight"))]
    edge = F.when(F.col("style") == 0, maps[0]).when(F.col("style") == 1, maps[1]).when(F.col("style") == 2, maps[2]).otherwise(maps[3])
    normal = retrieval.normal_edges(rows.select("graph", edge.alias("edge")), "graph")
    degrees = normal.groupBy("graph", "target").agg(F.count("*").alias("d"), F.count_if(F.col("type") == "edge").alias("untyped"))
    return degrees.groupBy("graph").agg(F.sum("d").alias("n_edges"), F.sum("untyped").alias("n_untyped"), F.count("*").alias("n_targets"), F.median("d").alias("median_degree"))


def tool_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.presence(table(spark, sf_dir, "documents"), "lang", "text", ["the", "token", "license", "public"])


def vec_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.norm_histogram(table(spark, sf_dir, "embeddings"), "embedding", 0.0, 20.0, 10)


def vec_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.principal_components(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.sharded(table(spark, sf_dir, "documents"), "doc_id", 3, 7)


def fn_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar functions over parts: versions, numbers in texts, templates, lists and maps."""
    rows = sql(spark, sf_dir, "SELECT p_partkey AS id, p_size, p_name, p_type, CASE p_partkey % 5 WHEN 0 THEN '12' WHEN 1 THEN ' -7 ' WHEN 2 THEN '3.5' WHEN 3 THEN 'x1' END AS raw, CASE p_partkey % 3 WHEN 0 THEN 'v' ELSE '' END || CAST(p_size AS STRING) || '.2.' || CASE WHEN p_partkey % 7 = 0 THEN 'x' ELSE CAST(p_partkey AS STRING) END AS version FROM part")
    words = F.split("p_name", " ")
    settings = F.create_map(F.lit("a"), F.col("p_size"), F.lit("b"), F.lit(1))
    return rows.select(
        "id",
        *(text.bumped(F.col("version"), w).alias(w) for w in ("major", "minor", "patch")),
        text.safe_int(F.col("raw"), -1).alias("number"),
        text.substituted(F.lit("{a}-{b}-{c}"), {"a": F.lit("{b}"), "b": F.col("p_name")}).alias("filled"),
        F.json_array_length(F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(", 2, [3]]"))).cast("long").alias("n_items"),
        F.array_join(F.array_distinct(F.concat(words, F.array(F.lit("z")), words)), " ").alias("distinct_words"),
        F.size(F.array_intersect(F.split(F.lower("p_type"), " "), words)).cast("long").alias("n_common"),
        (F.size(F.array_except(words, F.concat(words, F.array(F.lit("q"))))) == 0).alias("is_subset"),
        F.coalesce(F.try_element_at(settings, F.when(F.col("id") % 2 == 0, "a").otherwise("c")), F.lit(9)).cast("long").alias("setting"),
        F.map_keys(F.map_filter(F.map_zip_with(settings, F.create_map(F.lit("b"), F.lit(2)), lambda k, x, y: F.coalesce(y, x)), lambda k, v: v > 1)).getItem(0).alias("first_over_one"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three lines of each text that name a licence or a token, with their numbers."""
    rows = readers.facts(table(spark, sf_dir, "documents"), "doc_id", "text", {"licence": "licen[cs]e", "token": "token"})
    return rows.select("doc_id", "fact", F.col("line_no").cast("long").alias("line_no"), F.sha2("line", 256).alias("line_sha"))


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of events in windows of two hours that begin every hour, read as a stream."""
    stream = telemetry.windowed_counts(telemetry.read_events(spark, f"{sf_dir}/events*.parquet"), "2 hours", "40 days", "1 hour")
    return telemetry.drained(stream, "complete")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users, read as a stream: runs of events less than a day apart that the watermark has passed."""
    return telemetry.drained(telemetry.sessions(telemetry.read_events(spark, f"{sf_dir}/events*.parquet"), "1 day"), "append")


WORDS = [*inspection.LEAK_WORDS, "nav", "footer", "http"]


def rgx_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.keywords(F.col("text")).alias("keywords"))


def insp_keyword_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = inspection.word_hits(table(spark, sf_dir, "pages"), "page_id", "html", WORDS)
    return hits.groupBy("keyword").agg(F.count("*").alias("n_cells"), F.min("page_id").alias("first_cell"))


def insp_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.verbatim(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


PROFILED = ["doc_id", "lang", "source", "n_chars"]


def prj_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, share filled, distinct values and least example of columns, in one pass."""
    docs = table(spark, sf_dir, "documents").select(PROFILED)
    kinds = dict(docs.dtypes)
    sums = docs.agg(F.count("*").alias("n"), *(F.struct(F.count(c).alias("f"), F.count_distinct(c).alias("d"), F.min(c).cast("string").alias("e")).alias(c) for c in PROFILED))
    rows = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(kinds[c]).alias("kind"), F.round(F.col(c)["f"] / F.col("n"), 9).alias("filled"), F.col(c)["d"].alias("n_distinct"), F.col(c)["e"].alias("example")) for c in PROFILED))
    return sums.select(F.explode(rows).alias("r")).select("r.*")


REPORTS = """
    SELECT id, CASE WHEN id % 7 = 0 THEN ' ' WHEN id % 7 = 1 THEN '<testsuite tests="1"' ELSE '<testsuites><testsuite tests="' || CAST(n AS STRING) || '" failures="' || CAST(f AS STRING) || '"/><testsuite tests="2" errors="' || CAST(e AS STRING) || '" skipped="1"/></testsuites>' END AS xml
    FROM (SELECT l_orderkey AS id, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS f, sum(CASE WHEN l_tax >= 0.08 THEN 1 ELSE 0 END) AS e FROM lineitem GROUP BY l_orderkey) a"""


def junit_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.junit_counts(sql(spark, sf_dir, REPORTS), "xml")
    return rows.select("id", *(F.col(c).cast("long").alias(c) for c in ("tests", "failures", "errors", "skipped", "passed")))


QUERIES = {
    f.__name__: f
    for f in (
        task_features, diff_hunk_counting, patch_findings, diff_old_files, diff_new_tests, issue_signals, path_gold_rank, path_hits, graph_symbol_nodes, graph_resolve, graph_edges, tool_matrix,
        vec_histogram, vec_pca, shard_rows, fn_scalars, facts, rgx_keywords, insp_keyword_findings, insp_benchmark_overlap, prj_profile, junit_reports, stream_sliding, stream_sessions,
    )
}

_BRAND = "CAST(substr(p_brand, 7, 2) AS INT)"
_FILE_ROWS = f"""f AS (SELECT l_orderkey AS id, CASE WHEN {_BRAND} % 4 = 0 THEN 'tests/' WHEN {_BRAND} % 6 = 1 THEN 'src/debug_' ELSE 'src/' END || p_brand || '.py' AS path, (l_orderkey + {_BRAND}) % 5 AS st,
    count(*) FILTER (l_returnflag = 'A') AS added, count(*) FILTER (l_returnflag = 'R') AS deleted FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_brand)"""
_WORD = lambda w: f"regexp_matches(low, '(^|[^a-z0-9_/]){w}($|[^a-z0-9_])')"
_ANY = lambda words: "(" + " OR ".join(_WORD(w.replace(".", "[.]")) for w in words if len(w) >= 3) + ")"
_SIGNS = ["path", "module", "symbol", "traceback", "code", "hinted", "any_place"]

ORACLE = {
    "task_features": f"""
        WITH {_FILE_ROWS}, s AS (SELECT l_orderkey AS id, count(DISTINCT l_partkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber % 2 = 0 AND l_returnflag <> 'N' AND {_BRAND} % 4 <> 0 GROUP BY 1)
        SELECT f.id, count(*) AS n_files, count(*) FILTER (path LIKE 'src/%') AS n_src_files, coalesce(any_value(s.n), 0) AS n_symbols, count(*) AS n_hunks, sum(added) AS added, sum(deleted) AS deleted, sum(added + deleted) AS churn,
               bool_or(st = 0) AS adds_new_file, f.id % 10 <> 0 AS patch_ok FROM f LEFT JOIN s ON f.id = s.id GROUP BY f.id""",
    "diff_hunk_counting": f"WITH {_FILE_ROWS} SELECT id, path, added, deleted, 1 AS hunks, CASE st WHEN 0 THEN 'added' WHEN 1 THEN 'deleted' ELSE 'modified' END AS status FROM f",
    "patch_findings": f"""
        WITH {_FILE_ROWS}, g AS (SELECT * FROM f WHERE id % 17 <> 0), c AS (SELECT id, sum(added + deleted) AS churn FROM g GROUP BY id),
             x AS (SELECT DISTINCT ON (id) 'error' AS severity, 'empty patch' AS kind FROM f WHERE id % 17 = 0 UNION ALL SELECT 'error', 'looks like a leftover scratch file' FROM g WHERE st = 0 AND path LIKE 'src/debug%' UNION ALL SELECT 'error' AS severity, 'hunk line counts do not match the @@ headers (corrupted diff)' AS kind FROM c WHERE id % 10 = 0 UNION ALL SELECT 'warn', 'modifies a test file' FROM g WHERE path LIKE 'tests/%'
                   UNION ALL SELECT 'warn', 'very large patch (n changed lines)' FROM c WHERE churn > 6) SELECT severity, kind, count(*) AS n FROM x GROUP BY ALL""",
    "diff_old_files": f"WITH {_FILE_ROWS} SELECT id, path FROM f WHERE st <> 0",
    "diff_new_tests": "SELECT p_partkey AS id, 'test_' || replace(p_name, ' ', '_') || ',test_b' || p_size AS tests FROM part",
    "issue_signals": f"""
        WITH d AS (SELECT doc_id, lang, text || CASE doc_id % 17 WHEN 1 THEN ' Traceback (most recent call last): x' WHEN 2 THEN ' ```x``` src/main.py' WHEN 3 THEN chr(10) || '    code' WHEN 4 THEN ' xab abx ab_ /ab' ELSE '' END AS text, doc_id % 3 <> 0 AS hinted FROM documents),
             l AS (SELECT *, lower(text) AS low FROM d),
             s AS (SELECT lang, {_ANY(PATH_NEEDLES)} AS path, {_ANY(STEM_NEEDLES)} AS module, {_ANY(SYMBOL_NEEDLES)} AS symbol, contains(text, 'Traceback (most recent call last)') AS traceback,
                          contains(text, '```') OR contains(text, chr(10) || '    ') AS code, hinted FROM l), a AS (SELECT *, path OR module OR symbol OR traceback AS any_place FROM s)
        SELECT lang, count(*) AS n, {", ".join(f"round(count(*) FILTER ({s}) / count(*), 9) AS {s}" for s in _SIGNS)} FROM a GROUP BY ROLLUP (lang)""",
    "path_gold_rank": f"""
        WITH r AS (SELECT * FROM ({RANKED}) a WHERE path <> ''), g AS (SELECT task, regexp_extract(path, '([^/]*)$', 1) AS path FROM r WHERE page_id % 50 = 0)
        SELECT r.task, min(k) AS rank FROM r JOIN g ON r.task = g.task AND g.path <> '' AND (r.path = g.path OR ends_with(r.path, '/' || g.path) OR ends_with(g.path, '/' || r.path)) GROUP BY r.task""",
    "graph_symbol_nodes": """
        SELECT DISTINCT p_brand || '/mod' || p_partkey || '.' || replace(p_type, ' ', '_') || '#' || p_size AS id, p_name AS name, CAST(p_size AS VARCHAR) AS tail, replace(p_type, ' ', '_') || '.' || p_size AS label
        FROM part WHERE p_size < 6 OR p_name IN (SELECT p_name FROM part WHERE p_partkey % 50 = 0) OR p_name IN (SELECT CAST(p_size AS VARCHAR) FROM part WHERE p_size < 6) OR CAST(p_size AS VARCHAR) IN (SELECT p_name FROM part WHERE p_partkey % 50 = 0)""",
    "graph_resolve": f"""
        WITH n AS ({NODES}), q AS (SELECT DISTINCT CASE k % 5 WHEN 0 THEN id WHEN 1 THEN substr(id, 10) WHEN 2 THEN upper(id) WHEN 3 THEN substr(id, 3, 9) ELSE 'nowhere' END AS name FROM n),
             m AS (SELECT q.name, n.id, CASE WHEN n.id = q.name THEN 0 WHEN ends_with(n.id, '.' || q.name) OR ends_with(n.id, '/' || q.name) OR ends_with(n.id, '#' || q.name) THEN 1 WHEN lower(n.id) = lower(q.name) THEN 2 WHEN contains(n.id, q.name) THEN 3 END AS tier FROM q, n)
        SELECT name, id, tier FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY tier, id) AS r FROM m WHERE tier IS NOT NULL) x WHERE r = 1""",
    "graph_edges": """
        WITH e AS (SELECT l_suppkey % 5 AS graph, l_suppkey AS s, l_partkey AS t, max(CASE WHEN l_linenumber % 4 = 3 THEN 'edge' ELSE l_returnflag END) AS type FROM lineitem GROUP BY 1, 2, 3),
             d AS (SELECT graph, t, count(*) AS d FROM e GROUP BY 1, 2), x AS (SELECT graph, count(*) AS n_targets, median(d) AS median_degree FROM d GROUP BY 1)
        SELECT e.graph, count(*) AS n_edges, count(*) FILTER (type = 'edge') AS n_untyped, any_value(n_targets) AS n_targets, any_value(median_degree) AS median_degree FROM e JOIN x ON e.graph = x.graph GROUP BY e.graph""",
    "tool_matrix": """
        WITH t AS (SELECT unnest(['the', 'token', 'license', 'public']) AS word) SELECT lang, word, bool_or(regexp_matches(text, '\\b' || word || '\\b')) AS found FROM documents CROSS JOIN t GROUP BY ALL""",
    "vec_histogram": """
        WITH n AS (SELECT sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm FROM embeddings)
        SELECT CAST(CASE WHEN norm < 0 THEN 0 WHEN norm >= 20 THEN 11 ELSE floor(norm / 2) + 1 END AS BIGINT) AS bin, count(*) AS n FROM n GROUP BY 1""",
    "shard_rows": "SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents) a WHERE k % 7 = 3",
    "fn_scalars": """
        SELECT p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN (p_size + 1) || '.0.0' END AS major, CASE WHEN p_partkey % 7 <> 0 THEN p_size || '.3.0' END AS minor, CASE WHEN p_partkey % 7 <> 0 THEN p_size || '.2.' || (p_partkey + 1) END AS patch,
               CASE p_partkey % 5 WHEN 0 THEN 12 WHEN 1 THEN -7 ELSE -1 END AS number, p_name || '-' || p_name || '-{c}' AS filled, 3 AS n_items,
               array_to_string(list_transform(list_sort(list_transform(list_distinct(string_split(p_name, ' ')), lambda w: {'k': list_position(string_split(p_name, ' '), w), 'w': w})), lambda x: x.w), ' ') || CASE WHEN list_contains(string_split(p_name, ' '), 'z') THEN '' ELSE ' z' END AS distinct_words,
               len(list_intersect(list_distinct(string_split(lower(p_type), ' ')), string_split(p_name, ' '))) AS n_common, TRUE AS is_subset, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 9 END AS setting,
               CASE WHEN p_size > 1 THEN 'a' ELSE 'b' END AS first_over_one FROM part""",
    "facts": """
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents),
             h AS (SELECT *, 'licence' AS fact FROM l WHERE regexp_matches(line, '(?i)licen[cs]e') UNION ALL SELECT *, 'token' FROM l WHERE regexp_matches(line, '(?i)token'))
        SELECT doc_id, fact, k AS line_no, sha256(trim(line)) AS line_sha FROM h QUALIFY row_number() OVER (PARTITION BY doc_id, fact ORDER BY k) <= 3""",
    "stream_sliding": """
        WITH e AS (SELECT event_type, value, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events)
        SELECT start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM e GROUP BY ALL""",
    "stream_sessions": """
        WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 1 DAY THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
             s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 1 DAY AS "end", count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
}
ORACLE |= {
    "rgx_keywords": r"""
        WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-z_]{4,}') AND x NOT IN ('the', 'and', 'that', 'this', 'with', 'from', 'for', 'have', 'were')) AS words FROM documents)
        SELECT doc_id, CASE WHEN len(words) = 0 THEN 'issue' ELSE array_to_string(list_slice(words, 1, 3), ', ') END AS keywords FROM w""",
    "insp_keyword_findings": f"""
        WITH words AS (SELECT unnest([{", ".join(f"'{w}'" for w in WORDS)}]) AS keyword) SELECT keyword, count(*) AS n_cells, min(page_id) AS first_cell FROM pages CROSS JOIN words WHERE contains(lower(html), keyword) GROUP BY keyword""",
    "insp_benchmark_overlap": "SELECT DISTINCT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)",
    "prj_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{'string' if c in ('lang', 'source') else 'bigint'}' AS kind, round(count({c}) / count(*), 9) AS filled, count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS example FROM documents" for c in PROFILED
    ),
    "junit_reports": """
        WITH a AS (SELECT l_orderkey AS id, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS f, count(*) FILTER (l_tax >= 0.08) AS e FROM lineitem GROUP BY l_orderkey), k AS (SELECT *, CASE WHEN id % 7 < 2 THEN 0 ELSE 1 END AS k FROM a)
        SELECT id, k * (n + 2) AS tests, k * f AS failures, k * e AS errors, k AS skipped, greatest(k * (n + 1 - f - e), 0) AS passed FROM k""",
}
ORACLE["path_hits"] = f"""
        WITH t AS (SELECT DISTINCT page_id % 40 AS task FROM pages), r AS ({ORACLE["path_gold_rank"]}), x AS (SELECT 'repo_' || (t.task % 3) AS repo, rank FROM t LEFT JOIN r ON t.task = r.task)
        SELECT repo, count(*) AS tasks, round(count(*) FILTER (rank <= 1) / count(*), 9) AS hit1, round(count(*) FILTER (rank <= 5) / count(*), 9) AS hit5, round(count(*) FILTER (rank <= 10) / count(*), 9) AS hit10,
               round(coalesce(sum(1.0e0 / rank), 0) / count(*), 9) AS mrr FROM x GROUP BY ROLLUP (repo)"""
