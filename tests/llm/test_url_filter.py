import random

from pyspark.sql import functions as F

from quarryline.llm import url_filter as uf
from quarryline.llm.components import connected_components

SCHEMA = "page_id long, url string, html string"


def judge(spark, rows, redirects=None):
    edges = redirects and spark.createDataFrame(redirects, "src string, dst string")
    return {r.page_id: r for r in uf.judge_urls(spark.createDataFrame(rows, SCHEMA), uf.RULES, edges).collect()}


def test_rules(spark):
    urls = [
        "https://a.Example.ORG/es/1", "http://example.org/en/12?x", "http://example.org/en/2#/es/", "http://myexample.org/es/",
        "http://x.com/fr/1", "http://com/de/", "http://x.com/de", "http://x.net/de/", None, "no scheme", "http://", "x://org?/es/", "http://org.net/",
    ]
    got = judge(spark, [(i, u, "") for i, u in enumerate(urls)])
    assert [got[i].rule for i in range(len(urls))] == [
        "example.org/es/", "example.org/en/1", "org/", "org/", "com/fr/", "com/de/", None, None, None, None, None, "org/", None,
    ]
    assert [got[i].verdict[0] for i in range(len(urls))] == list("bbaaabaaaaaaa")
    assert (got[1].host, got[1].path) == ("example.org", "/en/12") and (got[8].host, got[8].path) == ("", "")
    assert (got[11].host, got[11].path) == ("org", "")


def test_blocks_reach_aliases_but_not_allowed_ones(spark):
    rows = [
        (1, "http://a.net/x#top", '<LINK href="http://b.net/y" rel="canonical">'),
        (2, "http://b.net/y", '<meta http-equiv="refresh" content="0; url=http://c.com/de/1">'),
        (3, "http://c.com/de/1", None),
        (4, "http://d.org/", "<link rel=canonical href=http://c.com/de/1>"),
        (5, "http://e.net/k/p", '<link rel="canonical" href="../k">'),
        (6, "http://f.net/", ""), (6, "http://f.net/", ""),
    ]
    got = judge(spark, rows, [("http://f.net/", "http://a.net/x"), (None, "http://a.net/x")])
    assert {k: v.verdict for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block"}


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", node string, rule int, match string")
    assert uf.judge_urls(df, uf.RULES).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(8, 60)] + [(7, 8), (9, 9), (None, 9)]
    df = spark.createDataFrame(path[::-1] + star, "u long, v long")
    got = dict(connected_components(df, "u", "v").collect())
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 60)}


def test_edges_are_normalised(spark):
    urls = ["HTTP://A.Net/b/../c?Q=1#f", "http://a.net", "http://a.net/x/./y/..", "http://a.net/%2e/../../z", "mailto:x", "http://a.net/a..b"]
    got = [r.n for r in spark.createDataFrame([(u,) for u in urls], "u string").select(uf.node("u").alias("n")).collect()]
    assert got == ["http://a.net/c?Q=1", "http://a.net/", "http://a.net/x/", "http://a.net/z", "mailto:x", "http://a.net/a..b"]
    html = "<!-- <link rel=canonical href=http://no.net/> --><script>'<link rel=canonical href=http://no.org/>'</script><link rel='canonical' href='../k?a=1&amp;b=2'><link rel=canonical href=?q><meta http-equiv=refresh content='1; URL=//h.net/m'>"
    links = uf.html_links(spark.createDataFrame([(1, "http://E.net/p/q/r", html)], SCHEMA)).collect()
    assert sorted(r.dst for r in links) == ["http://e.net/p/k?a=1&b=2", "http://e.net/p/q/r?q", "http://h.net/m"]


def test_against_brute_force(spark):
    rng = random.Random(6)
    urls = [f"http://{rng.choice(['a.net', 'x.com', 'sub.example.org', 'b.org', 'com'])}/{rng.choice(['es', 'de', 'fr', 'en'])}/{k}" for k in range(120)]
    edges = [(rng.choice(urls), rng.choice(urls)) for _ in range(45)]
    rows = [(k, u, "") for k, u in enumerate(urls)] + [(0, urls[0], "")]
    root = {u: u for u in urls}

    def top(u):
        while root[u] != u:
            u = root[u]
        return u

    for a, b in edges:
        root[top(a)] = top(b)

    def rule(u):
        host, path = u[7:].split("/", 1)
        fits = [(len(r), v) for v, r in uf.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith(r.split("/", 1)[1])]
        return max(fits)[1] if fits else None

    blocked = {top(u) for u in urls if rule(u) == "block"}
    want = {k: rule(u) or ("block" if top(u) in blocked else "allow") for k, u in enumerate(urls)}
    assert {k: r.verdict for k, r in judge(spark, rows, edges).items()} == want


def test_equal_lengths_long_urls_and_clashing_columns(spark):
    rules = [("block", "aa.b/cc/"), ("allow", "a.b/cccc/"), ("block", "b/x")]
    long = "http://aa.b/cc/" + "y" * 300_000
    df = spark.createDataFrame([(1, long, "<p>" * 50_000, "n", 5), (2, "http://b/x", None, None, None)], SCHEMA + ", node string, component long")
    got = {r.page_id: (r.rule, r.verdict) for r in uf.judge_urls(df, rules).collect()}
    assert got == {1: ("aa.b/cc/", "block"), 2: ("b/x", "block")}
    best = spark.createDataFrame([("a.b.c", "/dd")], "h string, p string").select(uf.matching_rule(F.col("h"), F.col("p"), [("allow", "c/dd"), ("block", "b.c/")]).alias("m")).first().m
    assert best.rule == "b.c/"  # as long as c/dd, of the longer host


def test_aliases_of_the_query_are_urls_letter_for_letter(spark, tmp_path):
    from quarryline.llm import queries

    # the URL of 1 is that of 3 but for its fragment; 5 has none, and lies between 11 and 2
    rows = [(1, "http://a.net/x#top", ""), (2, "http://a.com/de/", ""), (3, "http://a.net/x", ""), (4, "http://A.net/x", ""), (5, None, ""), (11, "http://b.net/", "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.verdict for r in queries.url_aliases(spark, str(tmp_path)).collect()}
    # links: 2 - 1, 4 - 2, 5 - 2, 11 - 5; 3 leads to none, and shares no URL
    assert got == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "block", 11: "block"}
