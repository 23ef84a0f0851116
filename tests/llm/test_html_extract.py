"""Article text: held-out layouts, the driver's pages, decoding and parsing rules."""

import html
import itertools
import os
import re
import time

import numpy as np
import pytest

from citymotion.llm import html_extract as H

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages():
    import pyarrow.parquet as pq

    if not os.path.exists(f"{SF}/pages.parquet"):
        pytest.skip("driver test data not present")
    return [(r["page_id"], r["html"]) for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]


@pytest.fixture(scope="module")
def model(pages):
    return H.train([H.plain_text(h)[:4000] for _, h in pages[:150]])


def marked_article(h):
    """What the article element holds, by plain string work."""
    inner = re.search(r"<article>(.*?)(</article>|$)", h, re.S).group(1)
    inner = re.sub(r"<br>|</?p>|</?h1>", " \x00 ", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner).replace("\x00", " ")).split())


def test_held_out_layouts(pages, model):
    draw = H.Layouts([H.plain_text(h)[:4000] for _, h in pages[150:]], seed=123)
    drawn = [draw.page() for _ in range(300)]
    gold = [H.article(p, [bool(g) for g in p.gold]) for p in map(H.Page, drawn)]
    got = H.extract([p.replace(" data-gold=1", "") for p in drawn], model)
    assert sum(a == b for a, b in zip(gold, got)) >= 0.9 * len(drawn)


def test_driver_pages(spark, pages, model):
    df = spark.createDataFrame([(i, "u", h, "clash") for i, h in pages], "page_id long, url string, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in H.with_text(df, model=model).collect()}
    assert got == {i: (marked_article(h), len(marked_article(h))) for i, h in pages}
    odd = spark.createDataFrame([(1, "u", None), (2, None, ""), (2, None, ""), (3, "u", "bare &amp; <b>text</b>"), (4, "u", "<p>x" * 3000), (None, "u", "<<<>")], "page_id long, url string, html string")
    rows = {r["page_id"]: r["text"] for r in H.with_text(odd).collect()}
    assert rows[1] == "" and rows[2] == "" and rows[3] == "bare & text"
    assert H.with_text(odd.limit(0)).count() == 0


def test_blocks_and_references():
    text = lambda h: H.plain_text(h)
    assert text("<p>a<b>b</b>c<p>d &lt;e&gt;&nbsp; f<br>g</p>h") == "abc d <e> f g h"
    assert text("<style>p{}</style><script>var t='</p>';x(1)</script><p>ok</p><!-- no --><noscript>no</noscript>") == "ok"
    assert text("<ul><li>1<li>2</ul><table><tr><td>3<td>4<tr><td>5</table></div>6") == "1 2 3 4 5 6"
    assert text("<title>no</title><p>unfinished <a href='") == "unfinished"


def test_self_closed_svg_and_math_are_empty():
    text = lambda h: H.plain_text(h)
    assert text("<p>a <svg class='i'/>b</p><p>c <math/>d</p>") == "a b c d"
    assert text("<p>a</p><svg><svg/>no<g/></svg><p>b</p>") == "a b"
    assert text("<p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</p><object>c</object>") == "a x=2 b c"


def test_decoding_is_the_most_likely_consistent_labelling():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = 7
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        odds = rng.normal(0, 2, n)
        best, value = None, -np.inf
        for labels in itertools.product(range(3), repeat=n):
            if labels[0] == 2 or any(labels[i] < labels[parent[i]] or (labels[i], labels[parent[i]]) == (2, 0) for i in range(1, n)):
                continue
            v = sum(-np.logaddexp(0, -o) if s == 1 else -np.logaddexp(0, o) for s, o in zip(labels, odds))
            if v > value + 1e-12:
                best, value = labels, v
        assert H.decode(parent, odds) == [s == 1 for s in best]


def test_trees_fit_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    t = H.fit_trees(x[:2000], y[:2000])
    assert ((t.scores(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95


def test_deep_pages_take_time_in_proportion():
    def seconds(n):
        begun = time.perf_counter()
        page = H.Page("<blockquote>" * n + "<p>x" * n + "</i></section>" * n)
        assert len(page.tag) == 2 * n + 1 and page.depth[-1] == n + 1
        return time.perf_counter() - begun

    seconds(500)
    assert seconds(16_000) < 40 * max(seconds(2_000), 0.005)
