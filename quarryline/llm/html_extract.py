"""Main-text extraction: boosted trees over DOM nodes with hierarchical decoding.

A page is read into a tree of block nodes, whose leaves are the runs of text between block boundaries. Boosted trees give
each node the probability that it holds main text, from its subtree's density, its own and its ancestors' attribute tokens,
depth and siblings. Decoding chooses the labelling of largest likelihood in which nothing below a rejected node is kept.
The trees are fitted on pages that are generated from a fixed seed, with known answers.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quarryline.llm.boosting import BoostedTrees

# Elements whose content is no markup and never page text; elements with markup inside that is no page text (controls of
# forms, and what is not shown); elements that begin a block; attribute tokens of each kind.
RAW = "script|style|title|textarea|iframe"
HIDDEN = {"select", "button", "template", "datalist"}
BLOCKS = "html body main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption form fieldset address details summary dialog menu hgroup center hr".split()
CLOSED_BY = {
    "p": set(BLOCKS),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
}
SCOPES = {"ul", "ol", "menu", "dl", "table", "html", "body"}
KINDS = {
    "nav": "nav menu menubar breadcrumb breadcrumbs pagination pager toolbar tabs sitemap skip",
    "head": "header masthead banner branding logo topbar hero site-header",
    "foot": "footer foot colophon copyright legal bottom imprint",
    "side": "sidebar side aside widget rail related recommended trending popular promo teaser secondary tags share social sharing follow author-box",
    "ad": "ad ads advert advertisement advertising sponsor sponsored adslot adsense banner-ad dfp promoted",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay disclaimer newsletter subscribe signup paywall message",
    "talk": "comment comments discussion disqus reply replies respond reactions thread feedback reader",
    "form": "form search login register field input contact poll survey",
    "main": "article content main post entry story text body copy prose page-content article-body post-content entry-content blog",
}
TOKEN_KIND = {t: k for k, words in KINDS.items() for t in words.split()}
TAG_KIND = {"nav": "nav", "menu": "nav", "header": "head", "footer": "foot", "aside": "side", "form": "form", "fieldset": "form", "dialog": "notice", "article": "main", "main": "main"}
TAGS = ["#text", "p", "div", "section", "article", "main", "body", "ul", "ol", "li", "table", "td", "blockquote", "pre", "figure", "figcaption", "address", "details"]

BLOCK_SET, KIND_LIST = set(BLOCKS), list(KINDS)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
SPLIT = re.compile(r"[^a-z0-9]+")
CLOSING = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.IGNORECASE) for t in HIDDEN}


class Node:
    __slots__ = ("tag", "parent", "depth", "kinds", "above", "children", "chars", "linked", "stops", "size", "text")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "") -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.kinds: set[str] = set()
        if tag in TAG_KIND:
            self.kinds.add(TAG_KIND[tag])
        if attributes:
            for value in ATTRIBUTE.findall(attributes):
                for name in "".join(value).lower().split():
                    parts = [name, *SPLIT.split(name)]
                    self.kinds.update(TOKEN_KIND[p] for p in parts if p in TOKEN_KIND)
        self.above: set[str] = parent.above | parent.kinds if parent else set()
        self.children: list[Node] = []
        self.chars = self.linked = self.stops = 0
        self.size = 1
        self.text = ""
        if parent:
            parent.children.append(self)


def parse(page: str) -> Node:
    """The tree of block nodes; leaves named #text hold runs of text with white space folded and references decoded.

    Other elements' text (of links, formulas, drawings, fallbacks) is part of the block that it stands in.
    """
    root = Node("root", None)
    at, run, linked, link = root, [], 0, 0
    skipped, unclosed = 0, set()

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                leaf = Node("#text", at)
                leaf.text, leaf.chars = text, len(text)
                leaf.linked = min(linked, leaf.chars)
                leaf.stops = text.count(".") + text.count(",")
            run.clear()
        linked = 0

    end = 0
    for m in TOKEN.finditer(page):
        if m.start() < skipped:
            continue
        if m.start() > end:
            piece = page[end : m.start()]
            run.append(piece)
            if link:
                linked += len(piece.strip())
        end = m.end()
        close, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if tag is None:
            continue
        tag = tag.lower()
        if tag in HIDDEN:
            if not close and tag not in unclosed and not attributes.endswith("/"):
                if closing := CLOSING[tag].search(page, end):
                    skipped = end = closing.end()
                else:
                    unclosed.add(tag)  # nothing further on closes it either
        elif tag == "a":
            link = 0 if close else 1
        elif tag == "br":
            run.append(" ")
        elif tag in BLOCK_SET:
            flush()
            link = 0
            if close:
                up = at
                while up is not root and up.tag != tag:
                    up = up.parent
                if up is not root:
                    at = up.parent
                continue
            up = at
            while up is not root and up.tag not in SCOPES:
                if tag in CLOSED_BY.get(up.tag, ()):
                    at = up.parent
                up = up.parent
            if tag != "hr":
                node = Node(tag, at, attributes)
                at = node
    if end < len(page):
        run.append(page[end:])
    flush()
    return root


def flatten(root: Node) -> list[Node]:
    """Nodes in page order, with the sums over their subtrees filled in."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed(node.children))
    for node in reversed(order):
        if node.parent:
            for name in ("chars", "linked", "stops", "size"):
                setattr(node.parent, name, getattr(node.parent, name) + getattr(node, name))
    return order


def features(order: list[Node]) -> list[list[float]]:
    """One row for each node."""
    total, before, out = max(1, order[0].chars), 0, []
    place = {}
    for node in order:
        place[id(node)] = [0, 0]
        for k, child in enumerate(node.children):
            place[id(child)] = [k, len(node.children)]
    for node in order:
        up = node.parent or node
        k, n = place[id(node)]
        tag = node.tag if node.tag != "#text" else up.tag
        out.append(
            [
                node.depth, node.chars, node.chars / total, node.linked / max(1, node.chars), node.size, node.chars / node.size,
                node.stops / max(1, node.chars), k, n, up.chars / max(1, n), node.chars / max(1, up.chars), before / total,
                up.linked / max(1, up.chars), float(node.tag == "#text"), float(tag[0] == "h" and tag[1:].isdigit()),
                *(float(tag == t) for t in TAGS[1:]),
                *(float(x in node.kinds) for x in KIND_LIST),
                *(float(x in node.above) for x in KIND_LIST),
            ]
        )
        if node.tag == "#text":
            before += node.chars
    return out


def decode(order: list[Node], probability: np.ndarray) -> list[str]:
    """Texts of the leaves kept by the most likely labelling without kept nodes below rejected ones."""
    p = np.clip(probability, 1e-9, 1 - 1e-9)
    keep, drop = np.log(p).tolist(), np.log1p(-p).tolist()
    index = {id(n): i for i, n in enumerate(order)}
    for i in range(len(order) - 1, 0, -1):
        up = index[id(order[i].parent)]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept, out = [True] + [False] * (len(order) - 1), []
    for i in range(1, len(order)):
        kept[i] = kept[index[id(order[i].parent)]] and keep[i] > drop[i]
        if kept[i] and order[i].tag == "#text":
            out.append(order[i].text)
    return out


def training_page(rng: random.Random) -> str:
    """A page with known answers: texts of main blocks begin with @."""
    syllables = "ka lo mi ter un vor sel na di pra to en is ge ru".split()

    def words(n: int) -> str:
        out = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
        for k in range(rng.randint(4, 12), n, rng.randint(6, 14)):
            out[k] += rng.choice(",.")
        return " ".join(out).capitalize()

    def attribute(kind: str, sure: float = 0.9) -> str:
        if rng.random() > sure:
            return rng.choice(["", ' class="c1"', ' class="wrap inner"', ' id="b7"'])
        token = rng.choice(KINDS[kind].split())
        return f' {rng.choice(["class", "id", "class"])}="{rng.choice(["", "site-", "js-", "c_"])}{token}{rng.choice(["", " x1", "-box"])}"'

    def links(n: int) -> str:
        return "".join(f"<li><a href='/{k}'>{words(rng.randint(1, 3))}</a></li>" for k in range(n))

    def boiler(kind: str) -> str:
        tag = {"nav": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind, "div")
        plain = tag == "div" or rng.random() < 0.35
        tag = rng.choice(["div", "section"]) if plain and kind != "form" else tag
        body = {
            "nav": lambda: f"<ul>{links(rng.randint(2, 9))}</ul>" if rng.random() < 0.75 else " &gt; ".join(f"<a href='/{k}'>{words(1)}</a>" for k in range(rng.randint(1, 4))),
            "head": lambda: f"<div><a href='/'>{words(2)}</a></div><p>{words(5)}</p>",
            "foot": lambda: rng.choice([f"&copy; {words(rng.randint(2, 25))}", f"<p>{words(12)}</p><ul>{links(3)}</ul>"]),
            "side": lambda: f"<h3>{words(2)}</h3>" + rng.choice([f"<ul>{links(5)}</ul>", f"<p>{words(rng.randint(8, 50))}</p>"]),
            "ad": lambda: rng.choice([words(rng.randint(3, 60)), f"<p>{words(15)}</p><a href='x'>{words(2)}</a>"]),
            "notice": lambda: rng.choice([f"<p>{words(rng.randint(6, 50))}</p>", words(rng.randint(5, 40))]),
            "talk": lambda: f"<h3>{words(1)}</h3>" + "".join(f"<div{attribute('talk', 0.6)}><p>{words(rng.randint(4, 70))}</p></div>" for _ in range(rng.randint(1, 5))),
            "form": lambda: f"<label>{words(2)}</label><p>{words(rng.randint(3, 20))}</p><input>",
        }[kind]()
        return f"<{tag}{attribute(kind, 0.97 if plain else 0.5)}>{body}</{tag}>"

    def main_blocks() -> str:
        out = [f"<h1>@{words(rng.randint(1, 10))}</h1>"] if rng.random() < 0.85 else []
        if out and rng.random() < 0.25:  # an article's own header
            out = [f"<{(tag := rng.choice(['header', 'div', 'hgroup']))}{attribute('head', 0.5)}>{out[0]}</{tag}>"]
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 14])):
            n = rng.choice([1, 2, 4, 12, 30, 60, 120])
            kind = rng.random()
            if kind < 0.68:
                out.append(rng.choice(["<p>@{}</p>", "<p>@{}</p>", "<p><b>@{}<br>", "<div>@{}</div>", "<p>@<a href='y'>{}</a></p>"]).format(words(n)))
            elif kind < 0.76:
                out.append(f"<h2>@{words(rng.randint(1, 6))}</h2>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>@{words(rng.randint(1, 15))}" for _ in range(3)) + "</ul>")
            elif kind < 0.89:
                out.append(f"<blockquote><p>@{words(n)}</p></blockquote>")
            elif kind < 0.93:
                out.append(f"<table><tr><td>@{words(2)}<td>@{words(2)}</table>")
            elif kind < 0.96:
                out.append(f"<pre>@{words(n)}</pre>")
            else:
                out.append(f"<figure><figcaption>@{words(5)}</figcaption></figure>")
        if rng.random() < 0.4:
            out.insert(rng.randint(0, len(out)), boiler(rng.choice(["ad", "side", "notice", "form", "nav"])))
        if not out:
            out = [f"@{words(30)}"]
        return "".join(out)

    tag = rng.choice(["article", "article", "main", "div", "section"])
    extra = attribute("main", 0.95) if tag in ("div", "section") else attribute("main", 0.3)
    inner = main_blocks()
    if rng.random() < 0.25:
        inner = f"<div{attribute('main', 0.5)}>{inner}</div>"
    if rng.random() < 0.3:
        inner += boiler("talk")
    # some pages have no element of their own around the article
    core = f"<{tag}{extra}>{inner}</{tag}>" if rng.random() < 0.8 else inner
    before = [boiler(k) for k in ("nav", "head", "ad", "notice", "side", "form") if rng.random() < 0.45]
    after = [boiler(k) for k in ("talk", "side", "ad", "form", "notice", "nav") if rng.random() < 0.35] + ([boiler("foot")] if rng.random() < 0.85 else [])
    if rng.random() < 0.12:
        before, after = [], []
    rng.shuffle(before)
    wrap = rng.random() < 0.3
    body = "".join(before) + core + "".join(after)
    return f"<html><body>{'<div id=page>' if wrap else ''}{body}{'</div>' if wrap else ''}</body></html>"


def labelled(page: str) -> tuple[list[Node], list[float]]:
    """Nodes of a training page and their labels; the marks are taken off."""
    root = parse(page)
    order, held = flatten(root), set()
    for node in order:
        if node.text.startswith("@"):
            node.text = node.text[1:].lstrip()
            up = node
            while up:
                held.add(id(up))
                up = up.parent
    return order, [float(id(n) in held) for n in order]


@functools.lru_cache(maxsize=2)
def trained(pages: int = 500, seed: int = 7) -> BoostedTrees:
    """The fitted trees; pages bounds the training set."""
    rng, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        order, y = labelled(training_page(rng))
        xs += features(order)
        ys += y
    return BoostedTrees().fit(np.array(xs), np.array(ys))


def extract(pages: list[str], model: BoostedTrees) -> list[str]:
    """The main text of each page, blocks joined by line feeds."""
    orders = [flatten(parse(p)) for p in pages]
    if not orders:
        return []
    p = model.probability(np.array([row for o in orders for row in features(o)]))
    ends = np.cumsum([len(o) for o in orders])
    return ["\n".join(decode(o, p[e - len(o) : e])) for o, e in zip(orders, ends, strict=True)]


def extract_pages(pages: DataFrame, model: BoostedTrees | None = None, chunk: int = 200) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each row of pages (page_id, url, html).

    A null or empty html gives an empty text; unclosed or stray tags close where HTML closes them; repeated rows are worked
    on each. There is no shuffle, memory is bounded by chunk pages, other columns are left out.
    """
    model = model or trained()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), chunk):
                part = batch.iloc[k : k + chunk]
                texts = extract([h or "" for h in part.html], model)
                yield pd.DataFrame({"page_id": part.page_id.astype("Int64").to_numpy(), "url": part.url.to_numpy(), "text": texts, "n_chars": [len(t) for t in texts]}).astype({"page_id": "Int64"})

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")
