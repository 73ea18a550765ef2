"""HTML extraction: whole pages with every kind of boilerplate, and odd pages."""

import html
import re

import pytest

from selenite.llm import extract_html
from selenite.llm.extract_html import main_text

LONG = "A sentence of some length that an article would have, followed by a second one about the same matter."
PAGE = f"""<!DOCTYPE html><html><head><title>Title | Site</title><style>p > a {{}}</style><script>document.write("<article>no</article>")</script></head>
<body class="has-sidebar"><header><a href="/">Site</a><p>Slogan of the site, which is rather long and reads like a sentence.</p></header>
<nav><ul><li><a href="/a">Home<li><a href="/b">News</a></ul></nav><div class="cookie-notice"><p>{LONG}</p><button>OK</button></div>
<main><div class="breadcrumb">Home / News</div><article><header><h1>The &lt;title&gt; &amp; more</h1></header><p>{LONG}
  On a  second\tline&nbsp;too.<p>Short.<ul><li>One <b>item</b><li>Another&#33;</ul><div class="ad"><p>Buy this. {LONG}</p></div>
<blockquote>Quoted</blockquote><form><label>Mail</label><input><p>{LONG}</p></form><p>First<br>second</p><footer>By someone</footer></article>
<section id="comments"><h2>Comments</h2><article class="comment"><p>{LONG} I disagree.</p></article></section></main>
<aside><p>{LONG}</p></aside><footer><p>{LONG}</p></footer></body></html>"""


def test_page():
    assert main_text(PAGE).split("\n") == ["The <title> & more", f"{LONG} On a second line too.", "Short.", "One item", "Another!", "Quoted", "First second"]


def test_no_article_declared():
    page = f'<body><div><a href="/">Home</a> <a href="/x">Other pages of this site</a></div><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div>' + '<a href="/">x</a>' * 20 + "</div></body>"
    got = main_text(page).split("\n")
    assert got[-4:] == [LONG, LONG, "Short.", LONG] and "xxx" not in "".join(got)


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<nav>only a menu</nav>", "<script>x = '<p>'</script>", "<!-- <article><p>x</p></article> -->"])
def test_nothing(page):
    assert main_text(page) == ""


@pytest.mark.parametrize(
    "page, want",
    [
        ("plain text", "plain text"),
        ("<article>a<p>b</b></i><p>c", "a\nb\nc"),
        ("<article><p>a &lt;p&gt; &am &#x1F600; &copy</p></article></article></div>", "a <p> &am \U0001f600 ©"),
        ("<article><p>a</p></article><p>after</p>", "a"),
        ('<article><p>a <span class="ad">no <span>no</span> no</span></p><p>b</p></article>', "a\nb"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
        ("<article><p class=no-ads>a</p></article>", "a"),
        ("<form><article><p>a</p></article></form>", "a"),
        ("<article><p>a &lt b<p>c < d &am", "a < b\nc < d &am"),
        ("<article><p>a</p><p>cut <b class='x", "a\ncut"),
        ("<article>" + "<a " * 100_000, ""),
        ("<script>var a = 1; // <p>", ""),
        ("<aside><article><p>teaser</p></article></aside><main><p>a</p></main>", "a"),
    ],
)
def test_cases(page, want):
    assert main_text(page) == want


def test_very_long_page():
    body = "".join(f"<p>Paragraph {i} with a few words.</p>" for i in range(30_000))
    got = main_text(f"<nav>menu</nav><article>{body}</article>")
    assert got.count("\n") == 29_999 and "menu" not in got


def plain(page):
    """The article of a synthetic page by its known grammar."""
    article = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split(r"<h1>|</h1>|<p>|</p>", article)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_tables_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = extract_html.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_rows(spark):
    kind = "page_id long, url string, html string, text string, n_chars string"
    rows = [(None, None, None, "x", "y"), (1, "u", "<article>a</article>", "x", "y"), (1, "u", "<article>a</article>", "x", "y")]
    got = sorted(map(tuple, extract_html.extract(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert got == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert extract_html.extract(spark.createDataFrame([], kind)).count() == 0
