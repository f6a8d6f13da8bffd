"""Queries over tasks, folds, results and rewards: projections, filters, joins, aggregates and windows."""

from __future__ import annotations

from quarryline.plans.dialect import SPARK

# Complexity tiers and the share and number of their limits.
TIERS = ("SIMPLE", "MODERATE", "COMPLEX")

#: One task result per order: its repository is the customer's segment; folds deal sorted repositories in turn.
RESULTS = """
    folds AS (SELECT repo, CAST((row_number() OVER (ORDER BY repo) - 1) % 4 AS BIGINT) AS fold
              FROM (SELECT DISTINCT c_mktsegment AS repo FROM customer) s),
    results AS (SELECT o_orderkey AS id, c_mktsegment AS repo, fold, o_orderstatus = 'F' AS resolved,
                       CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN 'SIMPLE'
                            WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'MODERATE' ELSE 'COMPLEX' END AS tier,
                       CAST(floor(o_totalprice / 12) AS BIGINT) AS tokens, CAST(o_orderkey % 97 AS BIGINT) AS tools,
                       o_orderstatus = 'P' AS truncated, o_orderdate AS created
                FROM orders JOIN customer ON o_custkey = c_custkey JOIN folds ON repo = c_mktsegment)"""


def rate(condition: str = "TRUE") -> str:
    """Share of resolved rows among those of a condition, 0 where there are none."""
    return f"round(coalesce(CAST(sum(CASE WHEN {condition} AND resolved THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0), 0), 9)"


def mean(x: str) -> str:
    return f"round(avg(CAST({x} AS DOUBLE)), 9)"


def count(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


QUERIES = {
    # SRC-01, SRC-02: tasks with every field as text, a default for what is missing
    "src_scan_tasks": lambda d: """
        SELECT CAST(o_orderkey AS STRING) AS instance_id, coalesce(c_mktsegment, '') AS repo, coalesce(o_orderstatus, '') AS base_commit,
               coalesce(o_orderpriority, '') AS problem_statement
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    # PRJ-04, SRC-17: short repository name: the last part between slashes
    "prj_repo_name": lambda d: f"""
        SELECT page_id, {d.get(d.split("trim(split_part(split_part(url, '://', 2), '?', 1))", "'/'"), "1")} AS host,
               element_at_last AS short_name FROM (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS element_at_last FROM pages) p""",
    # STR-01..04, FLT-01: three token estimates and the budget predicate
    "prj_token_estimate": lambda d: """
        SELECT doc_id, CAST(CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, ceil(length(text) / 4.0D)) END AS BIGINT) AS tokens,
               CAST(greatest(1, floor(length(text) / 4.0D)) AS BIGINT) AS rollout_tokens, CAST(floor(length(text) / 3.6D) AS BIGINT) AS rough_tokens,
               ceil(length(text) / 4.0D) <= 28672 AS fits
        FROM documents""",
    "flt_token_budget": lambda d: "SELECT doc_id, n_chars FROM documents WHERE CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, ceil(length(text) / 4.0D)) END <= 1000",
    # PRJ-08, PRJ-09: right-closed bins and clipping
    "prj_bins": lambda d: """
        SELECT bin, CAST(count(*) AS BIGINT) AS n, CAST(sum(least(k, 8)) AS BIGINT) AS clipped FROM (
            SELECT CASE WHEN k <= 5 THEN 'XS' WHEN k <= 20 THEN 'S' WHEN k <= 80 THEN 'M' WHEN k <= 300 THEN 'L' ELSE 'XL' END AS bin, k
            FROM (SELECT CAST(floor(n_chars / 25.0D) AS BIGINT) AS k FROM documents) a) b GROUP BY bin""",
    # FLT-05, FLT-06, FLT-14: two test-path predicates and the scratch-path one
    "flt_test_path": lambda d: f"""
        SELECT p_partkey, path, {d.matches("lower(path)", "test_|_test[.]py|tests/|test/|conftest[.]py|pytest[.]ini|pyproject[.]toml")} AS is_test,
               {d.matches("lower(path)", "repro|scratch|temp|tmp_")} AND NOT substr(path, 1, 5) = '/tmp/' AS is_scratch,
               {d.matches("path", "(^|/)test_[^/]*$|_test[.]py$|(^|/)(conftest[.]py|pytest[.]ini|setup[.]cfg|tox[.]ini)$|(^|/)tests(/|$)")} AS is_protected
        FROM (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '/tmp/' WHEN 1 THEN 'tests/' WHEN 2 THEN 'src/test_' WHEN 3 THEN 'Scratch/'
                     WHEN 4 THEN 'latest/' WHEN 5 THEN 'pkg/' ELSE '' END || replace(p_name, ' ', '_') ||
                     CASE p_partkey % 5 WHEN 0 THEN '_test.py' WHEN 1 THEN '/conftest.py' ELSE '.py' END AS path FROM part) a""",
    # FLT-08: is the last call of a conversation the closing one
    "flt_last_call": lambda d: """
        SELECT conv_id, last_role, last_role = 'assistant' AS closed FROM (
            SELECT conv_id, role AS last_role, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) a WHERE k = 1""",
    # FLT-09: curriculum of three epochs out of ten: simple, moderate too, all
    "flt_curriculum": lambda d: f"""
        WITH {RESULTS}, epochs AS (SELECT 3 AS epoch UNION ALL SELECT 7 UNION ALL SELECT 9)
        SELECT epoch, tier, CAST(count(*) AS BIGINT) AS n FROM results CROSS JOIN epochs
        WHERE tier = 'SIMPLE' OR (epoch / 10.0D >= 0.4D AND tier = 'MODERATE') OR epoch / 10.0D >= 0.8D GROUP BY epoch, tier""",
    # FLT-10: fold split where a missing fold trains
    "flt_fold_split": lambda d: f"""
        WITH {RESULTS}, dealt AS (SELECT id, CASE WHEN id % 10 = 0 THEN NULL ELSE fold END AS fold FROM results)
        SELECT id, fold IS NOT DISTINCT FROM 1 AS validates FROM dealt""",
    # FLT-11: over budget nulls the patch and marks it
    "flt_budget_gate": lambda d: f"""
        WITH {RESULTS} SELECT id, CASE WHEN tools > 80 OR tokens > 30000 THEN NULL ELSE tier END AS patch, tools > 80 OR tokens > 30000 AS had_truncation,
               resolved AND NOT (tools > 80 OR tokens > 30000) AS resolved FROM results""",
    # JON-01: left join with a default fold
    "join_fold_left_default": lambda d: """
        SELECT d.doc_id, CAST(coalesce(l.quality, 0) AS BIGINT) AS fold FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "join_semi_fold": lambda d: "SELECT doc_id, source FROM documents d LEFT SEMI JOIN labels l ON d.doc_id = l.doc_id" if d is SPARK else "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "join_anti_tools": lambda d: "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE d.doc_id = l.doc_id)",
    # JON-05..07: rows of two lists by position within a shard, the shorter ends it
    "join_positional": lambda d: """
        WITH a AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
             b AS (SELECT d.source, l.quality, row_number() OVER (PARTITION BY d.source ORDER BY l.doc_id) AS k FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
        SELECT a.doc_id, CAST(b.quality AS BIGINT) AS quality FROM a JOIN b ON a.source = b.source AND a.k = b.k""",
    # JON-08, WIN-04, PRF-01: ranked pairs of one task whose scores differ by more than 0.3
    "pref_pairs": lambda d: """
        WITH scored AS (SELECT l_orderkey AS task, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount * 10 AS score FROM lineitem),
             ranked AS (SELECT task, l_partkey AS gen, score, row_number() OVER (PARTITION BY task ORDER BY score DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM scored)
        SELECT a.task, a.gen AS chosen, b.gen AS rejected, round(a.score, 9) AS chosen_score, round(b.score, 9) AS rejected_score
        FROM ranked a JOIN ranked b ON a.task = b.task AND a.k < b.k AND a.score - b.score > 0.3D""",
    # JON-09: each task trains in the other folds and validates in its own
    "join_fold_complement": lambda d: f"""
        WITH {RESULTS} SELECT f.fold, {count("r.fold = f.fold")} AS n_val, {count("r.fold <> f.fold")} AS n_train
        FROM results r CROSS JOIN (SELECT DISTINCT fold FROM folds) f GROUP BY f.fold""",
    # JON-15, AGG-21: share of a repository in all
    "agg_share": lambda d: """
        SELECT source, CAST(n AS BIGINT) AS n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 9) AS share FROM (SELECT source, count(*) AS n FROM documents GROUP BY source) a""",
    # AGG-01, AGG-03: resolution rate and means by fold
    "agg_fold_rates": lambda d: f"""
        WITH {RESULTS} SELECT fold, CAST(count(*) AS BIGINT) AS total, {count("resolved")} AS n_resolved, {rate()} AS resolution_rate,
               {mean("tools")} AS mean_tools, {mean("tokens")} AS mean_tokens, {mean("CASE WHEN truncated THEN 1 ELSE 0 END")} AS truncation
        FROM results GROUP BY fold""",
    "agg_tier_rates": lambda d: f"WITH {RESULTS} SELECT fold, " + ", ".join(f"{rate(f'''tier = '{t}' ''')} AS rate_{t.lower()}" for t in TIERS) + " FROM results GROUP BY fold",
    # AGG-02, AGG-26, CVS-03: by fold and tier, with totals
    "agg_rollup_all": lambda d: f"""
        WITH {RESULTS} SELECT fold, tier, CAST(count(*) AS BIGINT) AS total, {count("resolved")} AS n_resolved, {rate()} AS resolution_rate FROM results GROUP BY ROLLUP(fold, tier)""",
    "agg_crosstab": lambda d: f"WITH {RESULTS} SELECT repo, " + ", ".join(f"{count(f'''tier = '{t}' ''')} AS n_{t.lower()}" for t in TIERS) + " FROM results GROUP BY repo",
    "agg_month_pivot": lambda d: f"SELECT {d.month('o_orderdate')} AS month, " + ", ".join(f"{count(f'''o_orderstatus = '{s}' ''')} AS n_{s.lower()}" for s in "FOP") + " FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1",
    "agg_value_counts": lambda d: "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type",
    "agg_quantiles": lambda d: f"""
        SELECT lang, round({d.quantile("n_chars", 0.5)}, 6) AS median, CAST(floor({d.quantile("n_chars", 0.9)}) AS BIGINT) AS p90, CAST(max(n_chars) AS BIGINT) AS longest FROM documents GROUP BY lang""",
    # AGG-27, SRT-06: the fifteen busiest files
    "agg_hot_files": lambda d: """
        SELECT path, n FROM (SELECT p_brand || '/' || p_type AS path, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) a
        ORDER BY n DESC, path LIMIT 15""",
    "agg_distinct_models": lambda d: "SELECT p_type, CAST(count(DISTINCT p_brand) AS BIGINT) AS n_models, count(DISTINCT p_brand) = 1 AS single FROM part GROUP BY p_type",
    # FLT-12: test tallies
    "agg_junit": lambda d: f"""
        SELECT id, n_tests, n_failed, greatest(n_tests - n_failed - n_errors, 0) AS n_passed, n_failed = 0 AND n_errors = 0 AND n_tests > 0 AS resolved FROM (
            SELECT l_orderkey AS id, CAST(count(*) AS BIGINT) AS n_tests, {count("l_returnflag = 'R'")} AS n_failed, {count("l_tax >= 0.08")} AS n_errors FROM lineitem GROUP BY l_orderkey) a""",
    # AGG-20, WIN-01..03: slopes over the last five days, without gaps, and the signal they give
    "agg_slope": lambda d: f"""
        WITH days AS (SELECT {d.day("ts")} AS day, avg(CASE WHEN event_type = 'click' THEN 1.0D ELSE 0.0D END) AS cv FROM events GROUP BY 1),
             numbered AS (SELECT day, cv, row_number() OVER (ORDER BY day) AS k FROM days)
        SELECT round(regr_slope(cv, k), 9) AS slope, CAST(count(*) AS BIGINT) AS n FROM numbered""",
    "win_trend": lambda d: f"""
        WITH days AS (SELECT {d.day("ts")} AS day, avg(CASE WHEN event_type = 'click' THEN 1.0D ELSE 0.0D END) AS cv,
                             CASE WHEN sum(CAST(event_id AS BIGINT)) % 3 = 0 THEN NULL ELSE avg(CASE WHEN event_type = 'view' THEN 1.0D ELSE 0.0D END) END AS lb FROM events GROUP BY 1),
             last5 AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY day DESC) AS back FROM days) a WHERE back <= 5),
             lbs AS (SELECT lb, row_number() OVER (ORDER BY day) AS k FROM last5 WHERE lb IS NOT NULL),
             slopes AS (SELECT (SELECT regr_slope(cv, -back) FROM last5) AS c, (SELECT regr_slope(lb, k) FROM lbs) AS l, (SELECT count(*) FROM lbs) AS n)
        SELECT round(c, 9) AS cv_slope, round(l, 9) AS lb_slope,
               CASE WHEN n < 2 THEN 'NONE' WHEN c > 0 AND l <= 0 THEN 'STRONG' WHEN c > 0 AND l > 0 AND c > 2 * l THEN 'MODERATE' ELSE 'NONE' END AS overfitting FROM slopes""",
    "win_gap_alert": lambda d: """
        SELECT hour, round(abs(cv - lb), 9) AS gap FROM (SELECT substr(CAST(ts AS STRING), 1, 13) AS hour, avg(CASE WHEN user_id % 2 = 0 THEN CASE WHEN event_type = 'click' THEN 1.0D ELSE 0.0D END END) AS cv,
               avg(CASE WHEN user_id % 2 = 1 THEN CASE WHEN event_type = 'click' THEN 1.0D ELSE 0.0D END END) AS lb FROM events GROUP BY 1) a WHERE abs(cv - lb) > 0.15D""",
    # WIN-04, SRT-01: rank by reward, stable
    "win_rank": lambda d: """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS k FROM lineitem""",
    # WIN-07..09: running tool calls without free ones, and the low-budget warning
    "win_budget": lambda d: """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, used, used >= 20 AND 30 - used <= 10 AS warns, greatest(30 - used, 0) AS remaining FROM (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) OVER (
                PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM lineitem) a""",
    # WIN-10, WIN-12: first turn of a role and what follows each turn
    "win_first_and_next": lambda d: """
        SELECT conv_id, turn, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
               turn = min(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS first_reply FROM conversations""",
    "set_union": lambda d: "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
    "set_intersect": lambda d: "SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9500 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    "set_except": lambda d: "SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    # RWD-01..06: outcome, efficiency, penalties and length, clamped
    "reward_total": lambda d: f"""
        WITH {RESULTS}, parts AS (SELECT id, CASE WHEN truncated THEN -1.0D WHEN resolved THEN 1.0D ELSE -0.5D END AS outcome,
                CASE WHEN tools < 0.7D * m THEN 0.15D WHEN tools < m THEN 0.15D * (1 - tools / CAST(m AS DOUBLE)) ELSE 0.0D END AS efficiency,
                CASE WHEN truncated THEN -0.2D ELSE 0.0D END AS penalty, CASE WHEN tokens > 24000 THEN -0.1D * power((tokens - 24000) / 4000.0D, 2) ELSE 0.0D END AS too_long
             FROM (SELECT *, CASE tier WHEN 'SIMPLE' THEN 6 WHEN 'MODERATE' THEN 12 ELSE 20 END AS m FROM results) a)
        SELECT id, round(greatest(-1.5D, least(1.3D, outcome + efficiency + penalty + too_long)), 9) AS reward FROM parts""",
    # DEC-01, DEC-02, AGG-17: comparison of two runs by fold and the decision
    "decision_matrix": lambda d: f"""
        WITH {RESULTS}, peers AS (SELECT fold, {rate("id % 2 = 0")} AS peer, {rate("id % 2 = 1")} AS baseline FROM results GROUP BY fold),
             c AS (SELECT avg(peer) - avg(baseline) AS improvement, {count("peer - baseline > 0")} AS improving, abs(avg(peer) - 0.3D) AS gap FROM peers)
        SELECT round(improvement, 9) AS improvement, improving, CASE WHEN gap > 0.2D THEN 'REJECT' WHEN improvement > 0.05D AND gap < 0.1D AND improving >= 3 THEN 'ADOPT'
               WHEN improvement > 0.02D THEN 'PARTIAL' ELSE 'REJECT' END AS decision FROM c""",
}

