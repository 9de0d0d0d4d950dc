"""HTML extraction: the supplied pages, pages with all kinds of boilerplate, and the cut itself."""

import html as entities
import itertools
import random
import re

from gridtally.llm import html
from gridtally.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def article(page):
    m = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", page, re.DOTALL)
    parts = re.split(r"</?(?:p|h1)>", m[1])
    words = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
    return "\n".join(w for w in words if w)


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = REGISTRY["op7_mincut_html"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


LONG = "This is a sentence of the article, which is long enough to look like prose. " * 3
PAGE = f"""<!doctype html><html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script>
<style>p > a {{}}</style></head><body class="single with-sidebar">
<header class="site"><a href=/>Home</a><p>Site slogan that goes on and on, {LONG}</p></header>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. {LONG}</p></div>
<div class="layout"><aside><p>About the author. {LONG}</p></aside>
<main><article><header><h1>Head&amp;line</h1></header>
<div class="ad-slot"><p>Buy now! {LONG}</p></div>
<p title="a > b">First   para&shy;graph
of&nbsp;text &lt;b&gt; {LONG}<p>Short.<p>See <a href=x>this link</a>
<ul><li>item one<li>item <em>two</em></ul><blockquote>Quoted.</blockquote>
<table><tr><td>cell 1<td>cell 2</table>
<form><label>Mail</label><input><button>Send</button><p>{LONG}</p></form>
<p>Last<br>line.</p>
<section id="comments"><h2>2 comments</h2><div class="comment"><p>I think: {LONG}</p></div></section>
</article></main>
<div class="sidebar widget"><h3>Related posts</h3><p>{LONG}</p></div></div>
<footer>&copy; 2024 Site. {LONG}</footer></body></html>"""


def clean(text):
    return " ".join(text.split())


def test_page_with_everything():
    want = ["Head&line", clean(f"First para\xadgraph of text <b> {LONG}"), "Short.", "See this link",
            "item one", "item two", "Quoted.", "cell 1", "cell 2", "Last line."]
    assert html.main_text(PAGE).split("\n") == want


def test_page_without_markers():
    page = (f"<div><a href=1>Home</a> <a href=2>News</a> <a href=3>Contact us</a></div><div><p>{LONG}</p>"
            f"<p>Short one.</p><p>{LONG}</p></div><div>© 2024 Somebody</div>")
    assert html.main_text(page).split("\n") == [clean(LONG), "Short one.", clean(LONG)]


def test_attributes_are_read_by_name():
    body = f"<p>{LONG}</p>"
    for wrapper in ('style="overflow:hidden"', 'data-id="nav"', 'class="page has-sidebar"', 'class="main no-ads"',
                    "title='hidden menu'"):
        assert html.main_text(f"<div {wrapper}>{body}</div>") == clean(LONG), wrapper
    for wrapper in ("hidden", 'class="x" hidden=""', 'aria-hidden="true"', 'id="sidebar"', "class='ads'"):
        assert html.main_text(f"<div {wrapper}>{body}</div>") == "", wrapper


def test_ordinary_wrappers_keep_their_text():
    body = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>"
    want = ["Head", clean(LONG), clean(LONG)]
    nav = "<nav><a href=1>One</a></nav>"
    for page in (
        f'<div class="post type-post tag-search category-notices">{body}</div>',
        f'<div class="section social-science">{body}</div>',
        f'{nav}<form id="aspnetForm" action="x"><div>{body}</div></form>',
        f'<form method=post>{nav}<main>{body}</main><footer>© 2024 Site</footer></form>',
        f'<div class="page-widget"><article>{body}</article></div>',
        f'<article><header class="entry-header"><h1>Head</h1></header><p>{LONG}</p><p>{LONG}</p></article>',
        f'<div class="post"><div class="post-header"><h1>Head</h1></div><p>{LONG}</p><p>{LONG}</p></div>',
    ):
        assert html.main_text(page).split("\n") == want, page[:80]


def test_parts_of_pages_still_go():
    body = f"<article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article>"
    want = html.main_text(body)
    assert want.count("\n") == 3
    for part in (
        f'<div class="post-comments"><p>{LONG}</p></div>', f'<div class="sidebar-content"><p>{LONG}</p></div>',
        f'<div class="social-links"><p>{LONG}</p></div>', f'<form><label>Name</label><p>{LONG}</p></form>',
        f'<div class="related"><article><h2>Other</h2><p>{LONG}</p></article></div>',
        f'<aside><article><p>{LONG}</p></article></aside>', f'<div class="main-header"><p>{LONG}</p></div>',
        f'<div hidden><article><p>{LONG * 9}</p></article></div>',
    ):
        assert html.main_text(body + part) == html.main_text(part + body) == want, part[:60]
    inside = body.replace("</article>", f'<div class="comments"><p>{LONG}</p></div></article>')
    assert html.main_text(f'<div class="widget">{inside}</div>') == want


def test_formulas_stay():
    page = "<article><p>For all <math><mi>x</mi> <mo>&gt;</mo> <mn>2</mn><annotation>x>2</annotation></math> holds.</p></article>"
    assert html.main_text(page) == "For all x > 2 holds."


def test_nested_tags_take_linear_time():
    import time
    for tag in ("ul", "div", "blockquote", "li", "section", "form"):
        started = time.perf_counter()
        assert html.main_text("<article>" + f"<{tag}>" * 50_000 + "deep text</article>") in ("deep text", "")
        html.main_text(f"<{tag}>" * 50_000 + "</p></td>" * 50_000 + "<li>" * 1000)
        assert time.perf_counter() - started < 4, tag


def test_odd_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<p> </p><!-- x") == ""
    assert html.main_text("<article><p>cut <b>off") == "cut off"
    assert html.main_text("<article>a < b & c &#233;&#x41;</article>") == "a < b & c éA"
    assert html.main_text("<article><p>a</p><script>x = '<p>no'</article>") == "a"
    assert html.main_text('<article><p class="x>y</p><p>z</p></article>') != ""
    deep = "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"
    assert html.main_text(deep) == "deep"
    many = "<article>" + "".join(f"<p>w{i}" for i in range(20000)) + "</article><nav>no</nav>"
    assert html.main_text(many).count("\n") == 19999


def test_cut_is_minimum():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 8)
        gain = [rng.randint(-6, 6) for _ in range(n)]
        ties = [(a, b, rng.randint(0, 4)) for a, b in itertools.combinations(range(n), 2)
                if rng.random() < 0.5]

        def cost(side):
            return (sum(g for g, s in zip(gain, side) if g > 0 and not s)
                    - sum(g for g, s in zip(gain, side) if g < 0 and s)
                    + sum(w for a, b, w in ties if side[a] != side[b]))

        best = min(cost(s) for s in itertools.product((True, False), repeat=n))
        assert abs(cost(html.minimum_cut(gain, ties)) - best) < 1e-6


def test_table(spark):
    rows = [(1, "<article>a</article>", "x"), (1, "<article>a</article>", "x"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, main_text string")
    assert sorted(r.main_text for r in html.extract(pages).collect()) == ["", "a", "a"]
    assert html.extract(pages.limit(0)).collect() == []
