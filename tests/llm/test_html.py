"""Main-text extraction: cuts against brute force, texts against the pages' own markup."""

import html as markup
import itertools
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vodlens.llm import html
from vodlens.llm import queries as Q
from vodlens.llm.common import read_table

SF = "/root/testdata/sf0.01"
P = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor."


def _cost(label, content, boilerplate, edges):
    return sum(content[k] if x else boilerplate[k] for k, x in enumerate(label)) + sum(c for a, b, c in edges if label[a] != label[b])


costs = st.floats(0, 8, allow_nan=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(costs, costs), min_size=1, max_size=9), st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8), st.floats(0, 4)), max_size=16))
def test_cut_is_least_of_all_labellings(ends, edges):
    n = len(ends)
    edges = [(a % n, b % n, c) for a, b, c in edges if a % n != b % n]
    content, boilerplate = (np.array(x) for x in zip(*ends, strict=True))
    best = min(_cost(x, content, boilerplate, edges) for x in itertools.product((False, True), repeat=n))
    assert _cost(html.least_cut(content, boilerplate, edges), content, boilerplate, edges) == pytest.approx(best, abs=1e-9)
    gain = boilerplate - content
    alone = html._source_side(gain.tolist(), edges)  # the flow itself, without blocks settled first
    assert _cost(alone, content, boilerplate, edges) == pytest.approx(best, abs=1e-9)


def _by_markup(page):
    article = re.search("<article>(.*?)</article>", page, re.S)[1]
    parts = (re.sub("<[^>]*>", "", re.sub("<br>", " ", x)) for x in re.split("</?p>|</?h1>", article))
    return "\n".join(x for x in (" ".join(markup.unescape(p).split()) for p in parts) if x)


def test_query_equals_the_articles(spark):
    pages = {r.page_id: r for r in read_table(spark, SF, "pages").collect()}
    got = Q.op11_main_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        want = _by_markup(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


LAYOUTS = {
    "divs": (f'<div id="header"><a href="/">Site</a><p>A slogan of the site.</p></div><ul class="menu"><li><a href=1>Home</a><li>About</ul><div id="content">'
             f'<h1>Title</h1><p>{P}</p><p>Short.</p><ul><li>one<li>two</ul></div><div class="sidebar"><h3>Latest</h3><p>{P}</p></div>'
             f'<div id="footer"><p>© 2024 Foo.</p></div>', f"Title\n{P}\nShort.\none\ntwo"),
    "main": (f'<header><h1>Site</h1><nav><a href=1>a</a></nav></header><main><h1>T</h1><p>{P}<div class="ad">Buy now, this is great!</div><p>x</p>'
             f'<aside><p>{P}</p></aside><form><p>Sign up here.</p><button>Go</button></form><section class="comments"><h2>Comments</h2><article><p>{P}'
             f'</article></section></main><footer><p>{P}</footer>', f"T\n{P}\nx"),
    "plain": (f"<p>{P}</p><p>ok</p><p>{P}</p>", f"{P}\nok\n{P}"),
    "names that tell nothing": (f'<div><a href=1>Home</a> | <a href=2>News</a></div><div><h2>Head</h2>{P}<br>{P}</div><div><a href=3>More</a></div>', f"Head\n{P} {P}"),
    "form around all": (f'<form id="f"><div class="nav"><a>x</a></div><div id="content"><h1>T</h1><p>{P}</p></div></form>', f"T\n{P}"),
    "menu left open": (f"<nav><ul><li><a href=1>x</a><li><a>y</a><article><h1>T<p>{P}<p>hi<footer>bye", f"T\n{P}\nhi"),
    "entities": (f'<div class="cookie-consent"><p>{P}</p></div><article><p>{P}</p><blockquote>Q &amp; &lt;b&gt; &eacute;&#8217;s&nbsp;x &copy y</blockquote>'
                 f'<pre>a\n  b</pre><dl><dt>t<dd>d</dl></article><div id="comments"><div class="comment"><p>{P}</div></div>',
                 f"{P}\nQ & <b> é’s x © y\na b\nt\nd"),
    "hidden": (f'<article><script>var t="</p><p>{P}";</script><style>p{{}}</style><!-- <p>{P}</p> --><p hidden>{P}</p><p>{P}</p><noscript>no</noscript><template><p>{P}</template></article>', P),
    "scripts only": ("<script>if (a < b) { x('<p>text</p>') }", ""),
    "not a page": ("3 < 4 & 5 > 2 is a plain text with a few words in it, and no markup at all.", "3 < 4 & 5 > 2 is a plain text with a few words in it, and no markup at all."),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page, want = LAYOUTS[name]
    assert html.main_text(page, html.PRIOR)[0] == want
    assert html.main_text(f"<html><body>{page}</body></html>", html.PRIOR)[0] == want


def test_fitted_weights_stay_near_the_prior(spark):
    pages = read_table(spark, SF, "pages")
    w = html.fit(pages)
    assert np.isfinite(w).all() and 0 < np.abs(w - html.PRIOR).max() < 2
    for page, want in LAYOUTS.values():
        assert html.main_text(page, w)[0] == want
    assert (html.fit(pages.limit(0)) == html.PRIOR).all()
    assert (html.fit(spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")) == html.PRIOR).all()


def test_long_and_deep_pages():
    t = time.time()
    long = "<article>" + f"<p>{P}</p><div class=ad>x</div>" * 20_000
    assert html.main_text(long, html.PRIOR)[0] == "\n".join([P] * 20_000)
    assert html.main_text("<div>" * 50_000 + f"<p>{P}", html.PRIOR)[0] == P
    assert html.main_text("<b><p>" * 30_000 + P + "</b>" * 30_000 + "<" * 5_000, html.PRIOR)[0].startswith(P)
    assert time.time() - t < 60


def test_edge_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "v", f"<p>{P}"), (3, "v", f"<p>{P}"), (None, "w", f"<article>{P}")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, html.extract(pages, html.PRIOR).select("page_id", "url", "text", "n_chars").collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (3, "v", P, len(P)), (3, "v", P, len(P)), (None, "w", P, len(P))], key=str)
    assert html.extract(pages.limit(0), html.PRIOR).count() == 0
