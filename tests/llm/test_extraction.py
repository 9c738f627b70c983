"""Extraction on pages with known main text, votes of hosts, broken markup, edge cases."""

import time

import pytest

from rowmill.llm.extraction import Page, host_of, host_paths, main_texts

RICH = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page-12">
<header><h1>Site name</h1><nav><a href="/">Home</a></nav></header>
<div class="cookie-notice">We use cookies</div><div id="leftSidebar"><p>Side text that is long enough to matter here.</p></div>
<div class="content-17"><header><h2>Title &amp; more</h2><p class="byline">By someone</p></header>
<p>First   paragraph with <a href="x">a link</a> and <b>bold</b>&nbsp;text.<br>Next line &lt;ok&gt;.</p>
<script>var x = "</p><p>no";</script><span class="ad">Buy now</span>
<ul><li>one<li>two</ul><table><tr><td>cell 1<td>cell 2</table>
<form><p>Your name</p><input value="q"></form><aside>Aside</aside>
<p>Last paragraph, a &#60; b and 5 &gt; 3<!-- hidden --> end.
<section class="comments"><p>Reader says hello hello hello hello hello hello hello.</p></section></div>
<footer>&copy; someone</footer></body></html>"""


def test_rich_page():
    page = Page(RICH.replace("<header><h2>", "<h2>").replace("</h2><p class=\"byline\">By someone</p></header>", "</h2>"))
    assert page.text("/body.page-#/div.content-#").split("\n") == [
        "Title & more", "First paragraph with a link and bold text. Next line <ok>.", "one", "two", "cell 1", "cell 2",
        "Last paragraph, a < b and 5 > 3 end.",
    ]
    assert page.best()[0] == "/body.page-#/div.content-#"


def test_headings_in_an_articles_header_stay():
    page = Page("<body><header><h1>Site</h1></header><article><header><h1>Title</h1><p>date</p></header><p>Text of it.</p></article></body>")
    assert page.text("/body/article") == "Title\nText of it."


def test_broken_pages():
    assert Page("<p>a<p>b").text("") == "a\nb"
    assert Page("text <b>cut <a hr").text("") == "text cut"
    assert Page("a <!-- never closed <p>x").text("") == "a"
    assert Page("x < y and <3 <p title='>'>z</p>").text("") == "x < y and <3\nz"
    assert Page('<div title="odd>quote</div><p>t</p>').text("")
    assert Page(None).text("/body") == "" and Page("").best() is None
    assert Page("<div>" * 3000 + "deep" + "</div>" * 10).text("/x") == "deep"


def test_hosts():
    assert host_of("HTTP://user@News.Example.org:80/x?y") == "news.example.org" and host_of(None) == host_of("no url") == ""


def test_host_votes_win(spark):
    good = "<body><div class='post'><p>{0} main text here, quite long indeed.</p></div><div class='other'><p>{1}</p></div></body>"
    rows = [(i, f"http://a.org/{i}", good.format(i, "short"), "x") for i in range(5)]
    rows += [(5, "http://a.org/5", good.format(5, "a much longer text than the main text of this page is, so it misleads alone. " * 3), "x")]
    rows += [(6, "http://b.org/", "<p>only</p>", "x"), (7, None, "<p>no url</p>", "x"), (8, "http://a.org/8", None, "x"), (None, "http://a.org/9", "", "x"), (6, "http://b.org/", "<p>only</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string")
    assert {r.host: r.path for r in host_paths(pages).collect()} == {"a.org": "/body/div.post", "b.org": "", "": ""}
    got = main_texts(pages).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[5] == "5 main text here, quite long indeed." and texts[6] == "only" and texts[7] == "no url" and texts[8] == texts[None] == ""
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_texts(pages.limit(0)).count() == 0


def test_votes_are_lifted_to_the_article(spark):
    long = "A long section of the article which holds most of the text of this page, without any doubt. " * 3
    article = f"<body><div class='x'>Elsewhere</div><article><h1>Title</h1><p>intro</p><section><h2>A</h2><p>{long}</p></section><p>between</p><section><p>{long}</p></section><p>after</p></article></body>"
    entry = f"<body><article><h1>Title</h1><div class='entry-content'><p>{long}</p></div><p>after</p></article></body>"
    plain = f"<body><div class='top'><p>Elsewhere</p></div><div class='post'><h1>Title</h1><div class='entry-content'><p>{long}</p></div></div></body>"
    direct = f"<body><h1>Title</h1><p>intro</p><div class='text'><p>{long}</p></div></body>"
    linked = f"<body><div class='wrap'><p><a href='/'>All of our other pages</a></p><div class='text'><p>{long}</p></div></div></body>"
    rows = [(i, f"http://{host}.org/{i}", page) for i, (host, page) in enumerate([("a", article), ("b", entry), ("c", plain), ("d", direct), ("e", linked)] * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.host: r.path for r in host_paths(pages).collect()} == {
        "a.org": "/body/article", "b.org": "/body/article", "c.org": "/body/div.post", "d.org": "/body", "e.org": "/body/div.wrap/div.text",
    }
    body = long.strip()
    want = [f"Title\nintro\nA\n{body}\nbetween\n{body}\nafter", f"Title\n{body}\nafter", f"Title\n{body}", f"Title\nintro\n{body}", body]
    assert {r.page_id: r.text for r in main_texts(pages).collect()} == dict(enumerate(want * 2))


def test_names_with_words_of_articles():
    long = "Much of the text of this page stands in this paragraph, so that it is the article. " * 3
    body = long.strip()
    text = lambda inner: Page(f"<body><article><p>{long}</p>{inner}</article></body>").text("/body/article")
    for inner, kept in [
        ("<h2 id='form-and-function'>Form and function</h2>", "Form and function"), ("<p class='notice'>Note this.</p>", "Note this."),
        ("<section id='discussion'><h2>Discussion</h2><p>We think so.</p></section>", "Discussion\nWe think so."),
        ("<div class='article-header'><h1>Title</h1></div>", "Title"), ("<ul><li id='search'>one</ul>", "one"),
    ]:
        assert text(inner) == f"{body}\n{kept}"
    for inner in ("<section class='comments'><p>Hello hello</p></section>", "<div class='share'><p>Tell others</p></div>", "<p class='ad'>Buy</p>", "<div id='site-header'>Top</div>", "<div class='related'><p>More</p></div>"):
        assert text(inner) == body
    wrapped = f"<body><div class='with-sidebar'><div class='text'><p>{long}</p></div><div class='sidebar'><p>Side</p></div></div><div class='ad'>Buy</div></body>"
    assert Page(wrapped).text("/body/div.with-sidebar") == body
    talk = f"<body><article><p>Short article.</p></article><section class='comments'><p>{long}</p></section></body>"
    assert Page(talk).text("/body") == "Short article."
    assert Page(talk.replace("<p>Much", "<article class='comment'><p>Much", 1)).text("/body") == "Short article."
    assert Page(f"<body><div id='no-comments'><h1>Title</h1><p>{long}</p></div></body>").text("/body") == f"Title\n{body}"


def test_pages_wrapped_in_a_form():
    long = "Much of the text of this page stands in this paragraph, so that it is the article. " * 3
    page = f"<html><body><form id='page'><nav>Menu</nav><div class='text'><h1>Title</h1><p>{long}</p><form><p>Your name</p></form></div></form></body></html>"
    assert Page(page).text(None if not (vote := Page(page).vote()) else vote[0]) == f"Title\n{long.strip()}"
    inner = f"<body><div class='text'><p>{long}</p><form><p>Your name</p></form></div><form><p>Search all of it</p></form></body>"
    assert Page(inner).text("/body") == long.strip()


def test_leads_in_an_articles_header_stay():
    page = Page("<body><article><header><h1>Title</h1><p class='article-lede'>What it says.</p><p class='byline'>By someone</p></header><p>Text of it.</p></article></body>")
    assert page.text("/body/article") == "Title\nWhat it says.\nText of it."


@pytest.mark.parametrize("piece", ["<div>", "<div>a", "<ul>x</ol>", "<div class='share'>b", "<td><table><x>a<th></th>", "<div class='share'><h1>c", "<span><span>d", "<li><b>e</i>"])
def test_hostile_megabyte(piece):
    began = time.process_time()
    page = Page(piece * (1_000_000 // len(piece)))
    page.text((page.vote() or ("/none",))[0])
    assert time.process_time() - began < 30
