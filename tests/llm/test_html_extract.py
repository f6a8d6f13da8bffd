import random

import numpy as np

from quarryline.llm import html_extract as he
from quarryline.llm.boosting import BoostedTrees

SCHEMA = "page_id long, url string, html string"


def texts(spark, *pages):
    df = spark.createDataFrame(list(enumerate(["u"] * len(pages))), "page_id long, url string")
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], SCHEMA).selectExpr("*", "1 as text")
    return [r.text for r in sorted(he.extract_pages(df).collect(), key=lambda r: r.page_id)]


def test_held_out_accuracy():
    rng, model, hit, false, missed = random.Random(1234), he.trained(), 0, 0, 0
    for _ in range(200):
        order, y = he.labelled(he.training_page(rng))
        want = {n.text for n, keep in zip(order, y, strict=True) if keep and n.tag == "#text"}
        got = set(he.decode(order, model.probability(np.array(he.features(order)))))
        hit, false, missed = hit + len(want & got), false + len(got - want), missed + len(want - got)
    assert hit / (hit + false) > 0.97 and hit / (hit + missed) > 0.97


def test_pages(spark):
    body = "<nav><ul><li><a href=/x>Home</a></ul></nav><!-- <p>no</p> --><div class='ad'>Buy now.</div>{}<footer>&copy; us"
    long = "Lorem ipsum dolor, sit amet. " * 3000
    got = texts(
        spark,
        body.format("<article><h1>A &amp; B</h1><p><b>One  two\n three.<br><p>Four &eacute;<script>var x='</p>';</script> five, six.</article>"),
        None, "", "   ", "<p", "plain words only, as text.",
        body.format(f"<article><h1>T</h1><p>{long}</p></article>"),
        body.format("<article><h1>Title</h1><p>Body text, of some length, is here.</p><div class='comments'><h3>Comments</h3><div class='comment'><p>Nice one, thanks.</p></div></div></article>"),
    )
    assert got[0] == "A & B\nOne two three.\nFour é five, six."
    assert got[1:5] == ["", "", "", ""]
    assert got[6] == "T\n" + " ".join(long.split())
    assert got[7] == "Title\nBody text, of some length, is here."


def test_decoding_never_keeps_below_a_rejected_node():
    root = he.parse("<div><p>a</p></div><div><p>b</p></div>")
    order = he.flatten(root)
    p = [{"root": 0.9, "div": 0.2, "p": 0.5, "#text": 0.5}[n.tag] for n in order]
    assert he.decode(order, np.array(p)) == []
    p = [{"root": 0.9, "div": 0.2, "p": 0.9, "#text": 0.9}[n.tag] for n in order]
    assert he.decode(order, np.array(p)) == ["a", "b"]


def test_repeated_rows_and_empty_table(spark):
    page = "<article><h1>Head</h1><p>Some text, and more of it.</p></article>"
    df = spark.createDataFrame([(1, None, page), (1, None, page), (None, "u", page)], SCHEMA)
    assert {r.text for r in he.extract_pages(df).collect()} == {"Head\nSome text, and more of it."}
    assert he.extract_pages(df.limit(0)).collect() == []


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    p = BoostedTrees(trees=30).fit(x[:1500], y[:1500]).probability(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.95


def article(inner):
    return f"<nav><ul><li><a href=/>Home</a><li><a href=/news>News</a></ul></nav><article><h1>T</h1>{inner}</article><footer>&copy; us</footer>"


def test_nothing_of_an_article_is_lost_to_foreign_or_self_closed_elements():
    first, second = "<p>First part of the story, as told.</p>", "<p>Second part of the story, as told.</p>"
    want = "T\nFirst part of the story, as told.\nSecond part of the story, as told."
    for between in ("<svg-icon></svg-icon>", "<svg width=1 />", "<math/>", "<object data=x />", "<script src=a />", "<style-guide x=1></style-guide>", "<button>", "<select><option>a", "<template-x>", "<iframe src='x'/>", "<titlebar></titlebar>", "<noscript></noscript>"):
        assert he.extract([article(first + between + second)], he.trained())[0].split("\n")[:3] in (want.split("\n"), [*want.split("\n")[:2], "a Second part of the story, as told."], [*want.split("\n")[:2], "a"]), between
    got = he.extract([article("<p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> follows from this, it is said.</p><p>Read <noscript>without scripts</noscript> on, and <object data=x>as told</object> <svg><text>drawn</text></svg> here.</p>")], he.trained())[0]
    assert got == "T\nEnergy E=m follows from this, it is said.\nRead without scripts on, and as told drawn here."
    hidden = "<p>Some of the story, as told. <button type=submit>Send <b>it</b></button><select><option>a</select><template><p>never</p></template> And more of it.</p>"
    assert he.extract([article(hidden)], he.trained())[0] == "T\nSome of the story, as told. And more of it."


#: Pages written by hand after common layouts, with the text that a reader would take.
BY_HAND = [
    (
        "<html><head><title>Weather | The Daily</title></head><body class='home'><header class='site-header'><a href='/'>The Daily</a><nav><a href='/w'>World</a> <a href='/s'>Sport</a></nav></header>"
        "<main id='content'><div class='breadcrumbs'><a href='/'>Home</a> &gt; <a href='/w'>Weather</a></div><h1>Storm reaches the coast</h1><p>The storm reached the coast on Monday evening, with gusts of up to 120 km/h.</p>"
        "<div class='advert'>Buy two umbrellas, get one free.</div><p>Trains were stopped for three hours. Nobody was hurt, officials said.</p><h2>What comes next</h2><ul><li>Rain until Wednesday</li><li>Then dry, and warmer</li></ul></main>"
        "<aside class='sidebar'><h3>Most read</h3><ul><li><a href='/1'>Cat saved</a></li><li><a href='/2'>New bridge</a></li></ul></aside><footer><p>Copyright 2024 The Daily. All rights reserved.</p></footer></body></html>",
        ["Storm reaches the coast", "The storm reached the coast on Monday evening, with gusts of up to 120 km/h.", "Trains were stopped for three hours. Nobody was hurt, officials said.", "What comes next", "Rain until Wednesday", "Then dry, and warmer"],
    ),
    (
        "<body><div id='cookie-banner'><p>We use cookies to make this site better. You may refuse them.</p><button>OK</button></div><div class='post'><h1 class='entry-title'>How to bake bread</h1>"
        "<div class='entry-content'><p>Mix flour, water, salt and yeast. Let the dough rest for an hour, or longer.</p><blockquote>Bread is patience, my grandmother said.</blockquote><table><tr><td>Flour</td><td>500 g</td></tr><tr><td>Water</td><td>350 g</td></tr></table>"
        "<p>Bake it for 40 minutes.</p></div></div><div id='comments' class='comments-area'><h3>2 replies</h3><div class='comment'><p>Great recipe, thanks a lot!</p></div><div class='comment'><p>Mine did not rise, what now?</p></div>"
        "<form id='commentform'><label>Your name</label><textarea></textarea></form></div><div class='footer'>Impressum</div></body>",
        ["How to bake bread", "Mix flour, water, salt and yeast. Let the dough rest for an hour, or longer.", "Bread is patience, my grandmother said.", "Flour", "500 g", "Water", "350 g", "Bake it for 40 minutes."],
    ),
    (
        "<body><ul class='menu'><li><a href='a'>Docs</a></li><li><a href='b'>API</a></li></ul><section class='article-body'><h1>Installing</h1><p>Run the installer, then restart the shell.</p><pre>make\nmake install</pre>"
        "<p>See <a href='c'>the guide</a> for more, or ask on the list.</p></section><div class='newsletter'><p>Subscribe to our newsletter and never miss a release.</p><form><input name='mail'></form></div><footer class='foot'><a href='x'>Imprint</a></footer></body>",
        ["Installing", "Run the installer, then restart the shell.", "make make install", "See the guide for more, or ask on the list."],
    ),
]


def test_pages_labelled_by_hand():
    got = [t.split("\n") for t in he.extract([p for p, _ in BY_HAND], he.trained())]
    want = [w for _, w in BY_HAND]
    hit = sum(len(set(g) & set(w)) for g, w in zip(got, want, strict=True))
    assert hit / sum(map(len, want)) >= 0.95 and hit / sum(map(len, got)) >= 0.95, got


def test_very_long_pages_of_tags_take_linear_time():
    page = article("<p>x, y.</p>" + "<button><select><b>" * 40_000)
    assert he.extract([page], he.trained())[0].startswith("T\nx, y.")


def test_pages_without_an_element_around_the_article():
    """Headings and paragraphs right in the body, alone or beside menus and footers, and headings in a header of the article's own."""
    text = "<p>One paragraph, with text of some length.</p><p>Another one, as told here.</p>"
    want = "Title here\nOne paragraph, with text of some length.\nAnother one, as told here."
    pages = [
        f"<body><h1>Title here</h1>{text}</body>",
        f"<h1>Title here</h1>{text}",
        f"<body><nav><a href=x>Home</a> <a href=y>News</a></nav><h1>Title here</h1>{text}<footer>Imprint</footer></body>",
        f"<body><div class='ad'>Buy two, get one free.</div><h1>Title here</h1>{text}<div id='comments'><p>Well told, thanks.</p></div></body>",
        f"<article><header class='entry-header'><h1>Title here</h1></header>{text}</article>",
        f"<header class='site-header'><a href=/>Site</a></header><article><header><h1>Title here</h1></header>{text}</article>",
    ]
    assert he.extract(pages, he.trained()) == [want] * len(pages)
    assert he.extract(["<body><h1>Title</h1>plain text that goes on for a while, and then ends.</body>"], he.trained()) == ["Title\nplain text that goes on for a while, and then ends."]
