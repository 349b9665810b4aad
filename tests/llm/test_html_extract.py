from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from wattspindle.llm import html_extract, queries
from wattspindle.llm.html_extract import extract

PAGE = """<html><body class="has-comments"><div id="page"><header class="site-header"><h1>Site</h1>
<ul class=menu><li><a href=#>a</a></ul></header>
<div class="cookie-notice">We use cookies, lots of them, for everything you can think of here</div>
<div class="wrap"><div class="col"><header><h1>Title &amp; more</h1><p class="byline">by me</p></header>
<p>First paragraph, with some commas, and enough length to count as a paragraph.
<p>Second one &eacute;t&eacute; &#8212; also, long
 enough&nbsp;to be   scored here, yes.
<div class="advert">Buy now, buy more, buy often, and never stop buying things today</div>
<ul><li>point <b>one</b> is here<li>point two is here</ul><blockquote>quoted, words are, in here.</blockquote>
<form><label>Email</label><input></form><table><tr><td>a<td>b<tr><td>c</table></div>
<aside>side, side, side stuff that is long enough to count as a paragraph</aside></div>
<section id="comments"><p>Great, really great post, I liked it a lot and will come back for more.</p></section>
<footer>foot</footer></div><script>if(a<b){"</p>"}</script></body>"""


def test_article_without_its_surroundings():
    assert extract(PAGE).split("\n") == [
        "Title & more",
        "First paragraph, with some commas, and enough length to count as a paragraph.",
        "Second one été — also, long enough to be scored here, yes.",
        "point one is here", "point two is here", "quoted, words are, in here.", "a b", "c",
    ]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain  text\nonly", "plain text only"), ("<p>short", "short"),
        ("<article>x</article>", "x"), ("a < b & c &am", "a < b & c &am"), ("<p>one<br>two<br><br>three", "one two\nthree"),
        ("<div" * 3000, ""), ("<div>" * 20000 + "deep text" + "</div>" * 10, "deep text"),
        ("<p class='x>broken quote</p><p>hello there", "broken quote\nhello there"),
        ("<p>kept</p><!-- no > comment --><p>too<!--", "kept\ntoo"), ("<script>var t='<p>x</p>'", ""),
        ("<title>t</title><p hidden>h</p><p style='display: none'>n</p><p>seen</p>", "seen"),
        ("<b><p>one<p>two</b> three</p>", "one\ntwo three"), ("\x00<p>\x00a</p>", "\x00\n\x00a"),
    ],
)
def test_odd_pages(source, text):
    assert extract(source) == text


def test_siblings_and_most_of_the_page():
    parts = "".join(f"<section><h2>H{i}</h2><p>{'word, ' * 30}</p></section>" for i in range(4))
    assert extract(f"<div>{parts}</div><div class=related><p>{'other, ' * 20}</p></div>").count("word,") == 120
    # A name like a menu's does not take the page away.
    assert extract(f"<div class=banner><p>{'word, ' * 30}</p></div><p>x</p>").count("word,") == 30


PROSE = "A first sentence, with commas, that is long enough to be scored as a paragraph of the page."
MORE = "Another one, also with commas, which goes on for long enough to count as a paragraph too."


@pytest.mark.parametrize(
    "attributes",
    ['data-title="The hidden costs of war"', 'class="md hidden-xs x"', "class='md hidden x'", "data-hidden=1", "title=hidden"],
)
def test_hidden_is_an_attribute_and_not_a_word_in_one(attributes):
    assert extract(f"<body><article {attributes}><p>{PROSE}<p>{MORE}</article></body>") == f"{PROSE}\n{MORE}"


@pytest.mark.parametrize("attributes", ["hidden", "hidden=''", "class=x hidden", "HIDDEN id=a", 'hidden="until-found"'])
def test_hidden_elements_are_left_out(attributes):
    assert extract(f"<article><p>{PROSE}<p {attributes}>{MORE}</article>") == PROSE


def test_a_form_around_the_page_is_not_a_form_in_it():
    controls = "<label>Name</label><input name=q><select><option>one</select><button>Send</button>"
    body = f"<div id=c><h1>Title</h1><p>{PROSE}</p><p>{MORE}</p></div>"
    assert extract(f"<body><form id=aspnetForm>{controls}{body}</form></body>") == f"Title\n{PROSE}\n{MORE}"
    article = f"<article><p>{PROSE}</p></article>"
    assert extract(f"<form>{controls}{article}<div class=menu>{MORE}</div></form>") == PROSE
    asked = f"<form><p>Write to us, we like that.</p>{controls}</form>"
    assert extract(f"<body>{body}{asked}</body>") == f"Title\n{PROSE}\n{MORE}"
    assert extract(f"<form>{controls}Search</form>") == ""


def test_an_article_keeps_what_is_in_it():
    page = f"""<body><ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>More</a></ul><article>
    <div class=top><h1>Head</h1></div><div><p>{PROSE}</p><p class="text notice-period">{MORE}</p>
    <ul><li><a href=4>one</a><li><a href=5>two</a><li><a href=6>three</a></ul></div>
    <div><p>The end.</p></div><p class=notice>Mind the step.</p></article><div>Elsewhere</div></body>"""
    assert extract(page).split("\n") == ["Head", PROSE, MORE, "one", "two", "three", "The end."]


def test_heading_and_end_in_wrappers_belong_to_the_text():
    page = f"""<body><div class=content><div><h1>Head</h1></div><div><p>{PROSE}</p><p>{MORE}</p></div>
    <div><p>The end.</p></div><div class=share>Tell others</div></div><div>Elsewhere</div></body>"""
    assert extract(page).split("\n") == ["Head", PROSE, MORE, "The end."]


def articles(source):
    """By the layout of the test pages: paragraphs and heading inside <article>."""
    part = source[source.index("<article>") + 9 :]
    end = min((part.index(e) for e in ("</article>", "<footer>") if e in part), default=len(part))
    blocks = re.split(r"</?(?:p|h1)>", part[:end])
    lines = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_query_matches_the_layout(llm, sf_dir):
    pages = llm.read.parquet(f"{sf_dir}/pages.parquet").toPandas()
    found = {r.page_id: r for r in queries.QUERIES["op4_html_extraction"](llm, sf_dir).collect()}
    assert len(found) == len(pages)
    for page in pages.itertuples():
        row = found[page.page_id]
        assert (row.url, row.text, row.n_chars) == (page.url, articles(page.html), len(row.text))


def test_nulls_clashes_and_empty_tables(llm):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>hello</p>")]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string")
    found = html_extract.main_text(pages.withColumn("text", F.lit("clash"))).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == [
        ("1", "", 0), ("1", "", 0), ("None", "hello", 5),
    ]
    assert html_extract.main_text(pages.limit(0)).collect() == []
