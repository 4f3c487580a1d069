"""Operator 12: hand-made sites, broken markup, and the pages of the tables by a plain rule."""

import html
import re

import duckdb
import pytest

from sievework.llm import html_extraction as hx

SF = "/root/testdata/sf0.001"
COLUMNS = "page_id long, url string, html string, host string, text string, hashes int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], COLUMNS)


def extracted(spark, rows, **how):
    return {r["page_id"]: r["text"] for r in hx.extract_main_text(frame(spark, rows), **how).collect()}


def plain(page):
    inner = re.search("<article>(.*)</article>", page or "", re.S)
    cut = re.split("</?(?:p|h1)>", inner[1] if inner else "")
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", x))).split()) for x in cut]
    return "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_is_the_articles(spark, size):
    d = f"/root/testdata/{size}"
    rows = duckdb.execute(f"SELECT page_id, url, html FROM '{d}/pages.parquet'").fetchall()
    got = sorted(tuple(r) for r in hx.op12_main_text(spark, d).collect())
    assert got == sorted((i, u, t, len(t)) for i, u, h in rows for t in [plain(h)])


def site_page(k, body):
    """A site without any telling tag or label: only recurrence shows what is template."""
    return (
        f"<html><body><div class=x1><div><a href=/{k}>Home</a> <span>World news</span></div></div><div class=x2><h1>Story {k}</h1>{body}</div>"
        f"<div class=x3>Written with care by the team of our town since 1900, call us</div></body></html>"
    )


def test_unlabelled_templates_go_by_recurrence(spark):
    rows = [(k, f"https://News.example.org/{k}", site_page(k, f"<p>Only page {k} tells of {k * k} things that came to pass in the long year {k}.</p><p>More of {k}.</p>")) for k in range(12)]
    rows += [(100, "https://lone.example.org/", site_page(1, "<p>A page of a site of its own stays whole.</p>"))]
    got = extracted(spark, rows)
    assert got[3] == "Story 3\n\nOnly page 3 tells of 9 things that came to pass in the long year 3.\n\nMore of 3."
    assert got[100].startswith("Home World news") and got[100].endswith("call us")
    assert extracted(spark, rows, broadcast_hashes=0) == got
    assert extracted(spark, rows, min_pages=100)[3] != got[3]


def test_an_articles_own_words_stay_even_if_many_pages_have_them(spark):
    page = lambda k: f"<body><div>Menu of the site</div><article><h1>News</h1><p>Licensed to all.</p><p>Story {k} is told here.</p><div class=box>Read it in our app</div></article><div>Imprint and all that</div></body>"
    got = extracted(spark, [(k, "http://a.example.com/", page(k)) for k in range(8)])
    assert got[5] == "News\n\nLicensed to all.\n\nStory 5 is told here."


def test_copies_of_a_page_are_no_template(spark):
    page = site_page(1, "<p>The one and only story of this site, copied to many addresses of it, stays.</p>")
    got = extracted(spark, [(k, f"http://a.example.com/{k}", page) for k in range(30)])
    assert all("copied to many addresses" in t and "Story 1" in t for t in got.values())


CLUTTER = """<!doctype html><html><head><title>T &amp; x</title><style>p{}</style></head><body class="no-sidebar has-comments">
<header><h2>Site</h2></header><nav>m</nav><div id="cookie-notice">We use cookies</div><div class="breadcrumbs">a &gt; b</div>
<main><article class="post"><header><h1>Title &mdash; one</h1></header><!-- hidden --><p>First   &eacute;<b>bo</b>ld &lt;tag&gt; a&nbsp;b
text</p><script>document.write("<p>no</p>")</script><div class="ad-slot ads">Buy</div><ul><li>one<li>two</ul>
<aside>See also</aside><form><label>Mail</label><input></form><table><tr><td>x<td>y</tr></table><noscript>no js</noscript>
<div hidden>not shown</div><span style="display: none">nor this</span><p>Last<br>line<footer>By me</footer></article>
<section id="comments"><p>Great post!</p></section></main><div class="sideBar">side</div><div role="contentinfo">foot</div><footer>f</footer></body></html>"""


def test_clutter_goes_by_tag_role_and_label():
    assert hx.main_text(CLUTTER) == "Title — one\n\nFirst ébold <tag> a b text\n\none\n\ntwo\n\nx y\n\nLast line"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("   ", ""),
        ("no markup, a < b && c > d", "no markup, a < b && c > d"),
        ("<p>one<p>two<b>bold<p>three</b></p>four", "one\n\ntwobold\n\nthree\n\nfour"),
        ("<p>cut <a href='x", "cut"),
        ("<p>cut<!-- never closed <p>x</p>", "cut"),
        ("<script>never closed <p>x</p>", ""),
        ("<p>&#65;&#x42;&amp;lt;&unknown;&copy</p>", "AB&lt;&unknown;©"),
        ("<DIV>Up<BR/>per</DIV><P CLASS=Footer>gone</P>", "Up per"),
        ("</div></p>stray</b>", "stray"),
        ("<p title='a > b'>x</p><p title=\"it's\">y</p>", "x\n\ny"),
        ("<form id=aspnet><main><p>kept</p></main><p>not</p></form>", "kept"),
        ("<article class=comment><p>me too</p></article><article><p>the story</p></article>", "the story"),
        ("<div class=sidebar><article>teaser</article></div><div><article>main</article></div>", "main"),
    ],
)
def test_markup_of_all_kinds(source, text):
    assert hx.main_text(source) == text


def test_hostile_markup_takes_linear_time():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert hx.main_text(deep) == "x"
    assert hx.main_text("<p>" * 50_000 + "y") == "y"
    assert hx.main_text('<a "' * 5_000 + "<p>z") is not None
    assert hx.main_text("<p>w</p>" + '<img src="data:' + "A" * 1_000_000 + '">v') == "w\n\nv"


def test_edges(spark):
    rows = [(1, None, None), (2, "not a url", "<p>a</p>"), (None, "http://u@H.example.com:80/x", "<p>b</p>"), (3, "", ""), (3, "", ""), (4, "http://h.example.com", "<p>word </p>" * 100_000)]
    df = frame(spark, rows)
    got = [tuple(r) for r in hx.extract_main_text(df).collect()]
    assert sorted(got, key=repr) == sorted([(i, u, "\n\n".join(re.findall(r"[a-z]+(?= ?</p>)", h or ""))) for i, u, h in rows], key=repr)
    assert hx.extract_main_text(frame(spark, [])).count() == 0
    hosts = [r[0] for r in df.select(hx.host(df["url"])).collect()]
    assert hosts == [None, None, "h.example.com", None, None, "h.example.com"]
