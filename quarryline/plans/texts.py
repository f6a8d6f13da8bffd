"""Queries over diffs, conversations, notebooks, graphs, vectors and terms."""

from __future__ import annotations

#: One patch per order: a file per brand with one hunk, whose lines are the order's items.
LINES = "CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE ' ' END || 'line_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING)"


def patches(d) -> str:
    body = d.agg(LINES, "chr(10)", "l_linenumber, l_partkey, l_suppkey, l_extendedprice")
    return f"""
    blocks AS (SELECT l_orderkey AS id, p_brand, 'diff --git a/' || p_brand || '.py b/' || p_brand || '.py' || chr(10) || '--- a/' || p_brand || '.py' || chr(10) || '+++ b/' || p_brand || '.py' || chr(10)
                      || '@@ -1,' || CAST(count(*) AS STRING) || ' +1,' || CAST(count(*) AS STRING) || ' @@' || chr(10) || {body} AS block
               FROM {d.gathered('lineitem JOIN part ON l_partkey = p_partkey', 'l_orderkey')} GROUP BY l_orderkey, p_brand),
    patches AS (SELECT id, {d.agg("block", "chr(10)", "p_brand")} AS patch FROM blocks GROUP BY id)"""


def lines(d) -> str:
    """The lines of all patches, numbered, with file and hunk by running counts of headers."""
    source = d.exploded("patches", d.split("patch", "chr(10)"))
    return f"""{patches(d)},
    lines AS (SELECT id, line, pos, substr(line, 1, 1) AS mark, line LIKE 'diff --git%' AS opens_file, line LIKE '@@ %' AS opens_hunk FROM {source} s),
    placed AS (SELECT *, CAST(sum(CASE WHEN opens_file THEN 1 ELSE 0 END) OVER w AS BIGINT) AS file_no, CAST(sum(CASE WHEN opens_hunk THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hunk_no
               FROM lines WINDOW w AS (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING))"""


BODY = "NOT opens_file AND NOT opens_hunk AND line NOT LIKE '--- %' AND line NOT LIKE '+++ %'"


def n(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


EDGES = "edges AS (SELECT DISTINCT l_suppkey AS source, l_partkey AS target FROM lineitem)"

QUERIES = {
    # PRJ-01..03: changed files and lines of a patch, and its tier
    "prj_complexity": lambda d: f"""
        WITH {lines(d)}, c AS (SELECT id, {n("opens_file")} AS n_files, {n("(mark = '+' AND line NOT LIKE '+++%') OR (mark = '-' AND line NOT LIKE '---%')")} AS n_lines FROM placed GROUP BY id)
        SELECT id, n_files, n_lines, CASE WHEN n_files <= 1 AND n_lines < 20 THEN 'SIMPLE' WHEN n_files <= 3 AND n_lines <= 100 THEN 'MODERATE' ELSE 'COMPLEX' END AS tier FROM c""",
    # WIN-14, DIF-01: lines of each file and hunk by side
    "win_diff_segments": lambda d: f"""
        WITH {lines(d)} SELECT id, file_no, hunk_no, {n(BODY + " AND mark <> '+'")} AS n_old, {n(BODY + " AND mark <> '-'")} AS n_new FROM placed WHERE hunk_no > 0 AND {BODY} GROUP BY id, file_no, hunk_no""",
    # DIF-03: blocks of a diff with paths and counts
    "diff_files": lambda d: f"""
        WITH {lines(d)} SELECT id, file_no, max(CASE WHEN opens_file THEN regexp_extract(line, 'a/([^ ]*) b/', 1) END) AS path,
               {n("mark = '+' AND line NOT LIKE '+++ %'")} AS added, {n("mark = '-' AND line NOT LIKE '--- %'")} AS deleted FROM placed GROUP BY id, file_no""",
    # DIF-05, RGX-01: hunk headers and the range to read around the first hunk
    "diff_read_range": lambda d: f"""
        WITH {lines(d)}, h AS (SELECT id, file_no, CAST(regexp_extract(line, '-([0-9]+)', 1) AS BIGINT) AS start, CAST(regexp_extract(line, '-[0-9]+,([0-9]+)', 1) AS BIGINT) AS size,
                row_number() OVER (PARTITION BY id, file_no ORDER BY pos) AS k FROM placed WHERE opens_hunk)
        SELECT id, file_no, greatest(1, start - 30) AS first_line, start + greatest(1, size) + 30 AS last_line FROM h WHERE k = 1""",
    # DIF-06: hunks of more than fifteen old lines are cut on both sides
    "diff_hunks": lambda d: f"""
        WITH {lines(d)}, h AS (SELECT id, hunk_no, {d.agg("CASE WHEN mark <> '+' THEN substr(line, 2) END", "'|'", "pos")} AS old_text, {n("mark <> '+'")} AS n_old FROM placed WHERE hunk_no > 0 AND {BODY} GROUP BY id, hunk_no)
        SELECT id, hunk_no, n_old, n_old > 15 AS is_cut, {d.sha("coalesce(old_text, '')")} AS old_sha FROM h""",
    # FLT-16, AGG-29: findings on patches by kind
    "diff_findings": lambda d: f"""
        WITH {lines(d)}, c AS (SELECT id, {n(BODY + " AND mark IN ('+', '-')")} AS churn, {n(BODY + " AND mark = '+'")} AS added FROM placed GROUP BY id)
        SELECT finding, CAST(count(*) AS BIGINT) AS n FROM (
            SELECT id, 'churn' AS finding FROM c WHERE churn > 6 UNION ALL SELECT id, 'no additions' FROM c WHERE added = 0 UNION ALL SELECT id, 'empty' FROM c WHERE churn = 0) f GROUP BY finding""",
    # FMT-01..03: conversations as delimited text
    "fmt_messages": lambda d: f"""
        SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, {d.sha("'<bos>' || " + d.agg("'<start_of_turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) || trim(text) || '<end_of_turn>'", "chr(10)", "turn") + " || chr(10)")} AS text_sha
        FROM conversations GROUP BY conv_id""",
    # AGG-09, AGG-10, SYN-08: token sums over turns, and the role counts
    "agg_turn_tokens": lambda d: f"""
        SELECT conv_id, CAST(sum(CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, ceil(length(text) / 4.0D)) END) AS BIGINT) AS tokens, {n("role = 'assistant'")} AS replies FROM conversations GROUP BY conv_id""",
    # RGX-04, JSN-02: tool calls in tags
    "rgx_tool_calls": lambda d: f"""
        WITH c AS (SELECT conv_id, turn, '<tool_call>{{"k": ' || CAST(conv_id * 7 + turn AS STRING) || '}}</tool_call>' AS raw FROM conversations)
        SELECT conv_id, turn, {d.json_int("regexp_extract(raw, '<tool_call>(.*)</tool_call>', 1)", "k")} AS k FROM c""",
    "jsn_payload": lambda d: f"SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum({d.json_int('props', 'k')}) AS BIGINT) AS total FROM events GROUP BY event_type",
    # AGG-18: severity rollup
    "insp_risk": lambda d: """
        SELECT source, CASE WHEN max(s) = 3 THEN 'critical' WHEN max(s) = 2 THEN 'medium' WHEN max(s) = 1 THEN 'low' ELSE 'clean' END AS risk FROM (
            SELECT source, CASE WHEN text LIKE '%token = %' THEN 3 WHEN lower(text) LIKE '%license%' THEN 2 WHEN text LIKE '%!!%' THEN 1 ELSE 0 END AS s FROM documents) a GROUP BY source""",
    # VEC-01, SRT-05: the eight nearest to a stored vector, without itself
    "vec_cosine_topk": lambda d: f"""
        SELECT vec_id, score FROM (SELECT e.vec_id, round({d.dot("e.embedding", "q.embedding")} / (sqrt({d.dot("e.embedding", "e.embedding")}) * sqrt({d.dot("q.embedding", "q.embedding")})), 6) AS score
            FROM embeddings e CROSS JOIN (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE e.vec_id <> 0) a ORDER BY score DESC, vec_id LIMIT 8""",
    "vec_norms": lambda d: f"""
        SELECT label, CAST(count(*) AS BIGINT) AS n, round(avg(norm), 6) AS mean_norm, CAST(max(dim) AS BIGINT) AS dim FROM (
            SELECT label, sqrt({d.dot("embedding", "embedding")}) AS norm, {d.lists}(embedding) AS dim FROM embeddings) a GROUP BY label""",
    # GRF-04, AGG-31: degrees
    "graph_indegree": lambda d: f"WITH {EDGES} SELECT target, degree FROM (SELECT target, CAST(count(*) AS BIGINT) AS degree FROM edges GROUP BY target) a ORDER BY degree DESC, target LIMIT 8",
    # GRF-05: neighbours of a node by direction
    "graph_neighbors": lambda d: f"WITH {EDGES} SELECT 'out' AS direction, target AS node FROM edges WHERE source = 7 UNION ALL SELECT 'in', source FROM edges WHERE target = 7",
    # GRF-06: the subgraph that some nodes induce
    "graph_subgraph": lambda d: f"WITH {EDGES} SELECT source, target FROM edges WHERE source IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000) AND target IN (SELECT p_partkey FROM part WHERE p_size = 1)",
    # TXT-01, TXT-02: term weights and the ranking of documents for a query of terms
    "tfidf_rank": lambda d: f"""
        WITH terms AS (SELECT doc_id, word AS term, count(*) AS tf FROM {d.exploded("documents", d.all_matches("lower(text)", "[a-z]{3,}"), "word")} t GROUP BY doc_id, word),
             df AS (SELECT term, count(*) AS df FROM terms WHERE term IN ('license', 'token', 'public', 'thou') GROUP BY term), total AS (SELECT count(*) AS n FROM documents)
        SELECT doc_id, score FROM (SELECT doc_id, round(sum((1 + ln(tf)) * (ln((1.0D + n) / (1 + df)) + 1)), 6) AS score FROM terms JOIN df ON terms.term = df.term CROSS JOIN total GROUP BY doc_id) a ORDER BY score DESC, doc_id LIMIT 20""",
    # AGG-28: rank of the first neighbour of the same label: hits and reciprocal ranks
    "agg_mrr_hitk": lambda d: f"""
        WITH q AS (SELECT vec_id, label, embedding FROM embeddings WHERE vec_id % 50 = 0),
             ranked AS (SELECT q.vec_id, q.label AS want, e.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY round({d.dot("e.embedding", "q.embedding")} / sqrt({d.dot("e.embedding", "e.embedding")}), 9) DESC, e.vec_id) AS k FROM q JOIN embeddings e ON e.vec_id <> q.vec_id),
             first AS (SELECT vec_id, min(CASE WHEN label = want THEN k END) AS r FROM ranked GROUP BY vec_id)
        SELECT round(avg(CASE WHEN r <= 1 THEN 1.0D ELSE 0.0D END), 9) AS hit1, round(avg(CASE WHEN r <= 10 THEN 1.0D ELSE 0.0D END), 9) AS hit10, round(sum(1.0D / r) / count(*), 9) AS mrr FROM first""",
    # pages whose paths end in one segment: the first of them and how many
    "join_suffix_theta": lambda d: """
        WITH paths AS (SELECT page_id, regexp_extract(regexp_extract(url, '://[^/]*(/[^?#]*)', 1), '([^/]*)$', 1) AS tail FROM pages)
        SELECT page_id, first_page, n FROM paths JOIN (SELECT tail AS t, CAST(min(page_id) AS BIGINT) AS first_page, CAST(count(*) AS BIGINT) AS n FROM paths GROUP BY tail) g ON t = tail WHERE tail <> ''""",
    "hsh_sha256": lambda d: f"SELECT doc_id, {d.sha('text')} AS digest FROM documents",
    # DOC-07: outputs cut to their first characters
    "doc_truncation": lambda d: "SELECT doc_id, length(text) > 5000 AS is_cut, CAST(length(substr(text, 1, 5000)) AS BIGINT) AS shown FROM documents",
    # DOC-02: which turns are masked, and their share of characters
    "doc_loss_mask": lambda d: "SELECT role, role <> 'assistant' AS masked, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY role",
}
