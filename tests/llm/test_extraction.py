from __future__ import annotations

import re
from html import unescape
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import extraction, queries
from larder.llm.extraction import main_text

LONG = "Some text that goes on for a while, long enough to be read. " * 3
SF = "/root/testdata/sf0.01"


def plain(html: str) -> str:
    """Blocks between the tags of the one article, for pages as simple as those of the test data."""
    inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_query_equals_the_articles_of_the_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.op13_html_extraction(spark, SF).collect()
    assert len(found) == len(pages)
    for row in found:
        assert row.text == plain(pages[row.page_id].html)
        assert (row.url, row.n_chars) == (pages[row.page_id].url, len(row.text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=8), st.data())
def test_cut_is_a_minimum_over_all_labellings(costs, data):
    n = len(costs)
    node = st.integers(0, n - 1)
    edges = [e for e in data.draw(st.lists(st.tuples(node, node, st.integers(0, 4)), max_size=12)) if e[0] != e[1]]

    def energy(labels):
        own = sum(max(c, 0) if not keep else max(-c, 0) for c, keep in zip(costs, labels))
        return own + sum(w for a, b, w in edges if labels[a] != labels[b])

    found = extraction._content_side(costs, edges)
    best = [x for x in product([False, True], repeat=n) if energy(x) == min(map(energy, product([False, True], repeat=n)))]
    assert tuple(found) in best
    assert sum(found) == max(map(sum, best))


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<p>hi</p>", "hi"),
        ("<title>no</title><p>yes", "yes"),
        (f"<nav><a>x</a></nav><p>{LONG}<p>Short<p>{LONG}<footer>all rights reserved</footer>", f"{LONG}\nShort\n{LONG}"),
        ("<article>a&nbsp;b &lt;i&gt; &#x41;&eacute;&amp;lt;<br>c<hr>d\n <b>e</b>f</article>", "a b <i> Aé&lt; c\nd ef"),
        ("<article><p>1<p>2<ul><li>3<li>4</ul><table><tr><td>5<td>6</table></article>", "1\n2\n3\n4\n5\n6"),
        ("<article>x<script>var t='</p><p>no'</script><style>no</style><!-- no <p>no --> y</article>", "x y"),
        ("<article><h1>T</h1><div class='ad'>Buy this now, it is the best of all. Really.</div><p>Ok.</p></article>", "T\nOk."),
        (f"<article><p>Ok.</p><section id='comments'><article class='comment'>{LONG}</article></section></article>", "Ok."),
        (f"<main><p>Ok.</p></main><div>{LONG}</div>", "Ok."),
        (f"<div class='cookie-notice'><p>{LONG}</p></div><div class='post'><p>{LONG}</p></div>", LONG),
        (f"<header><h1>Site</h1></header><div class='content with-sidebar'><h1>T</h1><p>{LONG}</p></div>", f"T\n{LONG}"),
        (f"<form><h1>T</h1><div>{LONG}</div></form>", f"T\n{LONG}"),
        ("<article><p>t</p><form>Sign up for the letter that we send each day. <input></form><aside>x</aside></article>", "t"),
        ("<article>All rights reserved.</article>", "All rights reserved."),
        ("<article><p>a < b</p><p class='x>q</p>z <b", "a < b\nq\nz"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    ],
)
def test_pages_by_hand(html, text):
    found, n_blocks, n_kept = main_text(html)
    assert found == "\n".join(" ".join(line.split()) for line in text.split("\n"))
    assert n_kept <= n_blocks


def test_deep_long_and_broken_pages_end():
    assert main_text("<div>" * 20_000 + "<p>hello</p>" * 20_000)[1:] == (20_000, 20_000)
    assert main_text('<a "' * 50_000)[0] == ""
    assert main_text("<article>" + "<p>x</p><div class=ad>y</div>" * 5_000)[1:] == (10_000, 5_000)


def test_nulls_repeats_extra_columns_and_empty_table(spark, rows):
    frame = rows(
        "page_id long, html string, main string, text string, _row map<string,int>",
        (1, "<p>hi</p>", "m", "t", {"a": 1}), (1, "<p>hi</p>", "m", "t", {"a": 1}), (None, None, None, None, None),
    )
    found = extraction.extract(frame, into="main")
    assert found.columns == ["page_id", "html", "text", "_row", "main"]
    assert sorted((r.page_id or 0, r.main.text, r.main.n_chars) for r in found.collect()) == [(0, "", 0), (1, "hi", 2), (1, "hi", 2)]
    assert extraction.extract(frame.limit(0)).count() == 0
