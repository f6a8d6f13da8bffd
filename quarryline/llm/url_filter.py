"""URL filter with redirect equivalence, DataFrame expressions only.

A rule is (verdict, "host/path"): it fits the URLs of its host and all its subdomains whose path starts with its path;
the longest rule that fits decides. Canonical links and refresh redirects in a page's html, and given redirects, make
URLs equivalent: connected components over these edges. A URL that no rule fits is blocked if a URL of its component is
blocked by a rule; an explicit allow rule always wins for the URLs it fits. All else is allowed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.components import connected_components

# The rules of the registered query.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

# Comments and scripts, whose tags do not count; then a tag of the kind, and the attribute that names the other URL.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"
CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'>\s]+)"
REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'>\s]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and raw path; both empty for null or where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"(?s)^([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, the one of the longer host on equal length; else null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[1])):
        own, start = rule.split("/", 1)
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit("/" + start))
        if not start:
            fits = (host == own) | F.endswith(host, F.lit("." + own))
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def node(url: Column) -> Column:
    """A URL as the server sees it: scheme and host in lower case, dots of the path resolved, without its fragment."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    head = F.regexp_extract(bare, r"(?s)^([^:/?#]+://[^/?]*)", 1)
    rest = F.substr(bare, F.length(head) + 1)
    path, query = F.regexp_extract(rest, r"(?s)^([^?]*)", 1), F.regexp_extract(rest, r"(?s)^[^?]*(.*)$", 1)
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    none = F.array().cast("array<string>")
    step = lambda acc, p: F.when(p == ".", acc).when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p)))
    tail = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise("")
    resolved = F.concat(F.lit("/"), F.array_join(F.aggregate(parts, none, step), "/"))
    resolved = F.when(resolved.endswith("/"), resolved).otherwise(F.concat(resolved, tail))
    dotted = path.rlike(r"(^|/)\.\.?(/|$)")
    return F.when(head == "", bare).otherwise(F.concat(F.lower(head), F.when(dotted, resolved).when(path == "", F.lit("/")).otherwise(path), query))


def absolute(link: Column, base: Column) -> Column:
    """A link's URL, from the page's own: absolute, scheme-relative, root-relative, a query alone or relative to the folder."""
    root = F.regexp_extract(base, r"(?s)^([^:/?#]+://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"(?s)^([^?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^([^:/?#]+://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.substring_index(base, "//", 1), link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .when(F.startswith(link, F.lit("?")), F.concat(page, link))
        .otherwise(F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"), link))
    )


def html_links(pages: DataFrame, named: Callable[[Column], Column] = node) -> DataFrame:
    """(src, dst): all canonical links and refresh redirects that pages state of themselves, outside comments and scripts."""
    shown = F.regexp_replace("html", HIDDEN, "")
    found = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv")).select("url", shown.alias("html"))
    found = found.select("url", F.explode(F.concat(*(F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (CANONICAL, REFRESH)))).alias("link"))
    return found.where("link <> '' and url is not null").select(named(F.col("url")).alias("src"), named(absolute(F.replace("link", F.lit("&amp;"), F.lit("&")), F.col("url"))).alias("dst"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None, named: Callable[[Column], Column] = node) -> DataFrame:
    """page_id, url, host, path, rule (null if none fits) and verdict for every row of pages (page_id, url, html).

    redirects: more edges (src, dst) between URLs. named: what URLs that are one have in common (see node). Null urls fit no rule and have no aliases; of rules of one length that of
    the longer host decides; repeated rows are judged each; URLs and pages of any length are read whole; an empty table gives
    an empty result; other columns are left out. The rules are a short list (each is one condition of the expression).
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"), named(F.col("url")).alias("node"))
    judged = judged.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    edges = html_links(pages, named)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(named(F.col("src")).alias("src"), named(F.col("dst")).alias("dst")))
    groups = connected_components(edges, "src", "dst")
    own = matching_rule(*host_and_path(F.col("node")), rules)["verdict"]
    blocked = groups.where(own == "block").select("component").distinct()
    aliases = groups.join(blocked, "component", "left_semi").select("node", F.lit(True).alias("blocked"))
    return judged.join(aliases, "node", "left").select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("match.rule").alias("rule"),
        F.coalesce("match.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
    )
