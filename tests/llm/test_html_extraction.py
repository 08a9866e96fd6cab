"""Main text of pages: hand-made pages, the given pages by a plain rule, the vote of a host."""

import html as references
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clipsense.llm import html_extraction, queries

from .test_corpus_operators import SF_DIR

SCHEMA = "page_id bigint, url string, html string, host string, paths int, salt int, text string"


def table(spark, rows):
    return spark.createDataFrame([(*r, None, 1, 2, "other") for r in rows], SCHEMA)


def own(html):
    return html_extraction.main_text(html, None)


def article_by_hand(page):
    """The given pages have one article element, made of headings and paragraphs."""
    found = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", found[1].replace("<br>", " ")) if found else []
    texts = [" ".join(references.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
    return " ".join(t for t in texts if t)


def test_given_pages(spark):
    df = queries.op13_html_extraction(spark, SF_DIR)
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    got = {r["page_id"]: r for r in df.collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        r = got[p["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (p["url"], article_by_hand(p["html"]), len(article_by_hand(p["html"])))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("just text, no markup", "just text, no markup"),
        ("<p>a&amp;b &lt;i&gt; &#233; &eacute; caf&eacute &unknown; &#x41;</p>", "a&b <i> é é café &unknown; A"),
        ("<p>one\n\ttwo&nbsp;&nbsp;three<br>four</p><p> </p><p>five</p>", "one two three four five"),
        ("<p>in<b>si</b>de a <em>block</em></p><p>next", "inside a block next"),
        ("<head><title>no<p>no</title><p>One.<p>Two <button><div>no</div></button> end.<ul><li>a<li>b</ul>", "One. Two end. a b"),
        ("<table><tr><td>c1<td>c2<tr><td>d</table>", "c1 c2 d"),
        ("<p>kept</p><script>var t='</p><p>no'</script><style>p{}</style><!-- <p>no</p> --><noscript>no</noscript>", "kept"),
        ("<p>Text. <span class='ad'>Buy</span>More.</p><p hidden>no</p><div style='display: none'>no</div>", "Text. More."),
        ("<form id=aspnet><div class=menu>no</div><article><p>All of it.</p></article></form>", "All of it."),
        ("<article><p>Truncated &amp", "Truncated &"),
        ("<article><p>Cut in a tag <a hre", "Cut in a tag"),
        ("<div></span></p></article><p>stray ends</b></p></div>", "stray ends"),
    ],
)
def test_small_pages(page, text):
    assert own(page) == text


LONG = "A sentence of the article that goes on for some words, as they do. " * 6


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href=/>Home</a></ul></nav>",
        "<header class='site-header'><h1>My site</h1><p>The best site.</p></header>",
        "<div class='navbar'>Home News Sport.</div>",
        "<div id='cookieBanner'><p>We use cookies on this site.</p></div>",
        "<div class='notice'><p>Maintenance on Sunday.</p></div>",
        "<div role='alert'>Maintenance on Sunday.</div>",
        "<aside><p>Read this too, it is long and interesting to read.</p></aside>",
        "<div class='right-sidebar'><p>Read this too.</p></div>",
        "<div class='ad-slot'><p>Buy now.</p></div>",
        "<div class='sponsored'>Buy now.</div>",
        "<form><p>Your mail address</p><input><label>Send.</label></form>",
        "<section id='comments'><h2>Comments</h2><article class='comment'><p>" + "I think so too. " * 60 + "</p></article></section>",
        "<div class='comment-list'><p>" + "I think so too. " * 60 + "</p></div>",
        "<footer><p>All rights reserved.</p></footer>",
        "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>",
    ],
)
@pytest.mark.parametrize("shape", ["<article><h1>T</h1><p>{}</p>{}<p>Of.</p></article>", "<main><h1>T</h1><p>{}</p>{}<p>Of.</p></main>"])
def test_what_is_around_the_article_is_left_out(around, shape):
    inner = around if "site-header" not in around else ""
    page = f"<html><body class='has-sidebar'>{around}{shape.format(LONG, inner)}{around}</body></html>"
    assert own(page) == f"T {LONG.strip()} Of."


def test_containers_without_names_of_their_own():
    page = f"<body><div class=x1><a href=1>A</a> <a href=2>B</a></div><div class=x2><h1>T</h1><div class=x3><p>{LONG}</p><p>Ja.</p></div></div><div class=x4>stray</div></body>"
    assert own(page) == f"T {LONG.strip()} Ja."
    assert html_extraction.vote(page) == "div.x#"


def test_the_host_decides_against_a_long_page_of_replies(spark):
    """One page's unnamed replies are longer than its article; the other pages of the host know better."""
    short = "The short article, told in a few words. " * 8
    page = "<body><div class='c post-{}'><p>{}</p></div><div class='z'><p>{}</p></div></body>"
    rows = [(i, f"https://A.example/{i}?x", page.format(i, LONG, "Ok.")) for i in range(9)]
    rows.append((9, "http://u:p@a.EXAMPLE:80/9", page.format(9, short, LONG * 5)))
    alone = [(10, None, rows[9][2]), (11, "no url", rows[9][2]), (12, "https://b.example", rows[9][2])]
    df = table(spark, rows + alone)
    paths = {r["host"]: r["paths"] for r in html_extraction.host_paths(df).collect()}
    assert paths == {"a.example": ["div.c.post-#", "div.z"], "b.example": ["div.z"]}
    for size in (10**6, 0):  # winners broadcast, and met by host and salt
        got = {r["page_id"]: r["text"] for r in html_extraction.extract(df, broadcast_bytes=size).collect()}
        assert got[9] == short.strip() and all(got[i] == LONG.strip() for i in range(9))
        assert got[10] == got[11] == got[12] == (LONG * 5).strip()


def test_two_templates_of_a_host(spark):
    old, new = f"<table><tr><td class=t>{LONG}</td></tr></table>", f"<main><p>{LONG}</p></main>"
    df = table(spark, [(i, "https://a.example/", old if i % 3 else new) for i in range(30)])
    assert html_extraction.host_paths(df).first()["paths"] == ["table>td.t", "main"]
    assert {r["text"] for r in html_extraction.extract(df).collect()} == {LONG.strip()}


def test_votes_below_the_share_do_not_win(spark):
    rows = [(i, "https://a.example/", f"<div class={'a' if i < 97 else 'b'}><p>{LONG}</p></div>") for i in range(100)]
    found = html_extraction.host_paths(table(spark, rows)).collect()
    assert [(r["host"], r["paths"]) for r in found] == [("a.example", ["div.a"])]


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "https://a.example/", f"<p>{LONG}</p>")] * 3 + [(None, None, None)]
    got = html_extraction.extract(table(spark, rows)).collect()
    assert Counter((r["page_id"], r["n_chars"]) for r in got) == {(1, len(LONG.strip())): 3, (None, 0): 1}
    assert html_extraction.extract(table(spark, [])).count() == 0


def test_deep_long_and_broken_pages_end():
    deep = "<div class=a>" * 50_000 + "<p>At the bottom.</p>"
    assert html_extraction.main_text(deep, [html_extraction.vote(deep)]) == "At the bottom."
    assert own("<p>" + "word " * 2_000_000 + "</p>") == ("word " * 2_000_000).strip()
    assert own("<b><div>" + "<i>" * 50_000 + "</b>" * 50_000 + "x") == "x"
    assert own("<div><table><tr><td>" + "<b>" * 50_000 + "</div>" * 50_000 + "x") == "x"
    draw = random.Random(2)
    bits = ["<p>", "</p>", "<div class=ad>", "</div>", "<td>", "<table>", "</table>", "<ul>", "<li>", "a ", "&amp;", "<a>", "</a>", "<!--", "-->", "<", ">", "</article>", "<article>", "<head>", "</b>", "<br/>"]
    for _ in range(300):
        own("".join(draw.choice(bits) for _ in range(60)))


def test_n_chars_are_code_points(spark):
    df = table(spark, [(1, "https://a.example/", "<p>ab &#128512; é</p>")])
    assert html_extraction.extract(df).select(F.sum("n_chars")).first()[0] == 6
