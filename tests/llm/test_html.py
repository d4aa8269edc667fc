from __future__ import annotations

import html as entities
import re

import pytest

from trendloom.llm import html
from trendloom.llm.queries import QUERIES

LONG = "A long paragraph with many words that tells the story of the page, one after the other."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("just text\n  of a page", "just text of a page"),
        ("<p>one<p>two <b>b</b>old<br>three<script>var t='</p>';</script><style>p{}</style><!-- no -->", "one two bold three"),
        (f"<article><h1>T &amp; U &eacute; &#8212; &#x41;</h1><p>{LONG}</p><p>To.</p></article>", f"T & U é — A {LONG} To."),
        (f"<nav><a href=x>Home</a></nav><article><p>{LONG}<p>Short.</article><footer>f</footer>", f"{LONG} Short."),
        (f"<article><header><h1>T</h1><p>by me</p></header><p>{LONG}</p><footer>end</footer><aside>see</aside></article>", f"T {LONG}"),
        (f"<header><h1>Site</h1></header><main><p>{LONG}</p><form>mail <input></form></main>", LONG),
        (f"<div class='menu'>Home About</div><div id=content><h2>H</h2><p>{LONG}</p><p>Bit.</p><p>{LONG}</p></div><div class='sidebar'>x</div><div class=cookieNotice>We use</div>", f"H {LONG} Bit. {LONG}"),
        (f"<article><p>{LONG}</p></article><section class='comments'><article><p>{LONG} {LONG} mine</p></article></section>", LONG),
        (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>c1<td>c2<tr><td>c3</table><pre>a\n  b</pre></article>", f"{LONG} one two c1 c2 c3 a b"),
        (f"<div><div class='ad'>Buy {LONG}</div><div role=navigation>go</div><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}</b></i></p></div><p>more", f"{LONG} more"),
        ("<article><p>a&nbsp;&nbsp;b &lt;p&gt; &unknown; &</p></article>", "a b <p> &unknown; &"),
        ("<script>only code</script><nav>menu</nav>", ""),
        (f"<div class='page has-sidebar no-ads'><div id=c><p>{LONG}</p><p>B.</p></div><div class=sidebar>x</div></div>", f"{LONG} B."),
        (f"<nav><a>Home</a><article><p>{LONG}</p></article>", LONG),
        (f"<div class='widget'><p>{LONG}</p></div>", LONG),
        ("<<<>>> < p <", "<<<>>> < p <"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("name", ["post category-social", "post tag-login", "category-promotion", "hentry comments-open"])
@pytest.mark.parametrize("tag", ["article", "div itemprop=articleBody", "div role=main"])
def test_articles_are_not_skipped_by_their_classes(name, tag):
    page = f"<a href='#c'>Skip</a><div>by me</div><{tag} class='{name}'><p>{LONG}</p></{tag.split()[0]}>"
    assert html.main_text(page) == LONG


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<p>12 May</p><nav><a>Home</a><article><p>{LONG}</p></article>", LONG),
        (f"<p>12 May</p><aside>see<article><p>{LONG}</p></article>", LONG),
        (f"<body><p>12 May</p><header><a>Home</a><article><p>{LONG}</p></article></body>", LONG),
        (f"<p>12 May</p><form><input><article><p>{LONG}</p></article></form>", LONG),
        (f"<a>Skip</a><form><div id=c><p>{LONG}</p><p>{LONG}</p></div><select><option>one</select></form>", f"{LONG} {LONG}"),
        (f"<body><a>Skip</a><nav><a>Home</a><div id=c><p>{LONG}</p><p>{LONG}</p></div></body>", f"{LONG} {LONG}"),
        (f"<a>Skip</a><div class='widget'><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
        (f"<div id=c><p>{LONG}</p></div><div class=comments><article><p>{LONG * 9}</p></article></div>", LONG),
        (f"<div id=c><p>{LONG}</p></div><nav>{'<a>a menu of many words</a> ' * 40}</nav><div class=footer>{LONG * 9}</div>", LONG),
        (f"<article><p>{LONG}</p></article><article class='comment-body'><p>{LONG} mine</p></article>", LONG),
    ],
)
def test_stray_lines_are_not_taken_for_the_article(page, text):
    assert html.main_text(page) == text


MENU = "".join(f"<div><a href=x>l{i}</a></div>" for i in range(9))


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div><div>{f'<p>{LONG}</p>' * 9}</div><div><p>{LONG} last</p><p>End.</p></div></div>", f"{' '.join([LONG] * 9)} {LONG} last End."),
        (f"{MENU}<div><h1>The title</h1></div><div>{f'<p>{LONG}</p>' * 9}</div>{MENU}", f"The title {' '.join([LONG] * 9)}"),
        (f"{MENU}<section><p>{LONG} lead</p></section><div>{f'<p>{LONG}</p>' * 9}</div><div>by me</div><section><p>{LONG}</p><p>B.</p></section>{MENU}", f"{LONG} lead {' '.join([LONG] * 9)} by me {LONG} B."),
        (f"<table><tr><td>{f'<p>{LONG}</p>' * 9}<td><p>{LONG} last</p></table>{MENU}", f"{' '.join([LONG] * 9)} {LONG} last"),
        (f"{MENU}<div>{f'<p>{LONG}</p>' * 9}</div>{MENU}", " ".join([LONG] * 9)),
        (f"<div>{f'<p>{LONG}</p>' * 5}<p>{LONG * 60}</p></div><div><p>{LONG}</p></div>", f"{' '.join([LONG] * 5)} {LONG * 60} {LONG}"),
    ],
)
def test_articles_in_several_elements(page, text):
    assert html.main_text(page) == text


def test_lines_cluster_by_smoothed_ratio():
    page = "".join(f"<div><a href=x>l{i}</a></div>" for i in range(12)) + f"<p>{LONG}</p><p>{LONG}</p>" + "".join(f"<div><a>m{i}</a></div>" for i in range(12))
    reader = html.Reader()
    reader.feed(page)
    reader.close()
    reader.cut()
    chosen = html.content_lines(reader.lines)
    assert chosen[12:14].all() and not chosen[:10].any() and not chosen[16:].any()


def test_very_long_and_deep_pages():
    assert html.main_text("<article>" + f"<p>{LONG}</p>" * 5000 + "</article>") == " ".join([LONG] * 5000)
    assert html.main_text("<div>" * 3000 + LONG) == LONG


def test_rows_are_kept_with_their_columns(spark):
    rows = [(1, "u", f"<p>{LONG}</p>"), (1, "u", f"<p>{LONG}</p>"), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "9 AS text", "8 AS n_chars", "7 AS __html2")
    got = html.extracted(pages)
    assert got.columns == ["page_id", "url", "__html2", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == [(0, "", 0), (1, LONG, len(LONG)), (1, LONG, len(LONG)), (2, "", 0)]
    assert html.extracted(pages.limit(0)).count() == 0


def test_query_against_cutting_out_the_article(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op1_main_text"](spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
        assert r.text == " ".join(entities.unescape(inner).split()) and r.n_chars == len(r.text)


def test_ratio_of_text_to_tags():
    lines = [html.Line("x" * 40, 4, (1,), 0)] * 5
    assert html.ratios(lines) == pytest.approx([10.0] * 5)




BOXES = "ad-container site-footer page-footer page-sidebar sidebar-wrapper comments-container comments-wrapper cookie-notice-container newsletter-wrapper related-posts-container site-header"


@pytest.mark.parametrize("name", BOXES.split())
def test_names_of_boxes_tell_what_is_in_them(name):
    prose = "<p>" + "The article says many things here, one after another. " * 4 + "</p>"
    want = " ".join(["The article says many things here, one after another."] * 4)
    for page in (f"<article>{prose}<div class='{name}'>Buy this now!</div></article>", f"<div class='content'>{prose}</div><div id='{name}'>Buy this now!</div>"):
        if name != "site-header" or "<article>" not in page:
            assert html.main_text(f"<html><body>{page}</body></html>") == want


@pytest.mark.parametrize("name", ["has-sidebar", "page-wrapper", "site-container", "sidebar-page-container", "comments-open", "with-footer", "page", "main-content-container"])
def test_names_of_layouts_hold_the_article(name):
    assert html.main_text(f"<div class='{name}'><p>The article says this.</p><p>And more of it.</p></div>") == "The article says this. And more of it."


@pytest.mark.parametrize("piece", ["<b>x", "<div>x", "<div><b>x", "<p>x<b>y</i>", "<li>x<a>", "</b><td>x"])
def test_the_work_grows_with_the_length(piece):
    import time

    started = time.perf_counter()
    html.main_text(piece * 50_000)
    assert time.perf_counter() - started < 5


def test_columns_that_differ_in_case_are_replaced(spark):
    pages = spark.createDataFrame([(1, "<p>One.</p>", "x", "y", 7)], "page_id long, html string, TEXT string, HTML_ string, N_Chars int")
    rows = html.extracted(pages)
    assert sorted(rows.columns) == sorted(["page_id", "HTML_", "text", "n_chars"])
    assert rows.first().text == "One."
