import time

import numpy as np
import pytest

from tests.llm.conftest import prose
from trawl.llm import blocks


def page(i, paragraphs=6):
    art = "".join(f"<p>{prose(100 * i + k, 40)}</p>" for k in range(paragraphs))
    return (f"<!DOCTYPE html><html><head><title>{prose(i, 4)}</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>"
            f"<nav><ul><li><a href='/a'>{prose(i + 1, 1)}</a><li><a href='/b'>two</a></ul></nav><div class=\"ad\">{prose(i + 2, 6)}</div>"
            f"<article><h1>Head&amp;line {i}</h1>{art}</article><!-- gone --><footer>&copy; site {i}</footer></body></html>")


def truth(i, paragraphs=6):
    return "\n".join([f"Head&line {i}", *(prose(100 * i + k, 40) for k in range(paragraphs))])


@pytest.fixture(scope="module")
def trained(spark):
    df = spark.createDataFrame([(i, f"http://x/{i}", page(i)) for i in range(80)], "page_id long, url string, html string")
    return blocks.fit(df, steps=160)


def test_blocks_of_markup():
    leaf = lambda h: [b[0] for b in blocks.leaf_blocks(h)]
    assert leaf("<p>a<br>b &amp; c<p>d &#233;&#x20AC; <li>x<li>y") == ["a b & c", "d é€", "x", "y"]
    assert leaf("<p>a <b>bold</b>\n\t c</p>tail<script>x</p>") == ["a bold c", "tail"]
    assert leaf("<a title='x>y'>t</a><!-- no --> 1 < 2 <textarea>no</textarea>") == ["t 1 < 2"]
    assert leaf("") == [] and leaf("plain") == ["plain"]
    assert blocks.leaf_blocks("<div class='Side-Bar x1' id=top><p>a")[0][1] == ("div", "side", "bar", "x", "top", "p")


def test_letters_that_grow_in_lower_case():
    leaf = lambda h: [b[0] for b in blocks.leaf_blocks(h)]
    dots = "\u0130" * 40
    assert leaf(f"{dots}<script>var a = 1;</SCRIPT><p>abc</p>") == [dots, "abc"]
    assert leaf(f"{dots}<script>x</script><p>abc") == [dots, "abc"]
    assert leaf(f"{dots}<script>x</script >{'y' * 30}<script>leak</script>z") == [dots + "y" * 30 + "z"]
    assert leaf("<p>a<\u017fcript>b") == ["a<\u017fcript>b"]  # no tag


def test_only_what_is_not_shown_goes():
    leaf = lambda h: [b[0] for b in blocks.leaf_blocks(h)]
    assert leaf("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds<xmp>a <b> &amp; c</xmp><p>d") == ["so x=1 holds", "a <b> &amp; c", "d"]
    for t in ("svg", "object", "canvas", "template"):
        assert leaf(f"<p>a <{t} id='x>y'><{t}>no</{t}><i>no</i></{t.upper()}> b<p>c") == ["a b", "c"]
        assert leaf(f"<p>a <{t}/>b<p>c") == ["a b", "c"]
        assert leaf(f"<div>a <{t}></div><p>b</p><p>c") == ["a", "b", "c"]  # without an end tag
        assert leaf(f"<p>a <{t}><p>b</p><{t}>no</{t}>c") == ["a", "b", "c"]
    assert leaf("<p>a<svg><title>no</svg><p>b") == ["a", "b"]
    assert leaf("<p>a<svg><script>'</svg>'</script>no</svg>b") == ["ab"]
    assert leaf("<svg-icon>a</svg-icon><title-bar>b</title-bar><p>c") == ["ab", "c"]
    assert leaf("<p>a<script>b") == ["a"]


@pytest.mark.parametrize("hostile", ["<svg>" * 100_000, "<p>a<svg></p>" * 50_000, "<svg>" * 50_000 + "</svg>" * 50_000, "<canvas><svg></canvas>" * 50_000, "<i><svg></i>x" * 50_000])
def test_hostile_nesting_is_linear(hostile):
    t = time.time()
    blocks.leaf_blocks(hostile)
    assert time.time() - t < 5


@pytest.mark.parametrize("hostile", ["<" * 400_000, "<a \"" * 100_000, "<div>x" * 50_000, "<b>x" * 100_000, "<!--" * 100_000, "<p class='" * 50_000, "</div>x" * 50_000])
def test_hostile_markup_is_linear(hostile):
    t = time.time()
    blocks.leaf_blocks(hostile)
    assert time.time() - t < 5


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    lens = np.array([4, 2])
    x, u = rng.normal(size=(4, 2, 12)), rng.normal(size=(3, 12)) * 0.5
    target = rng.normal(size=(4, 2, 3))
    loss = lambda: float((blocks.run_direction(x, u, lens) * target).sum())
    keep = []
    blocks.run_direction(x, u, lens, keep)
    target[2:, 1] = 0
    dx, du = blocks.run_direction_back(u, keep, target.astype(np.float32))
    for a, g, at in ((u, du, (0, 1)), (u, du, (2, 10)), (x, dx, (1, 0, 4)), (x, dx, (0, 1, 7))):
        old = a[at]
        a[at] = old + 1e-2
        up = loss()
        a[at] = old - 1e-2
        down = loss()
        a[at] = old
        assert abs((up - down) / 2e-2 - g[at]) < 2e-2


def test_held_out_pages(spark, trained):
    df = spark.createDataFrame([(i, f"http://x/{i}", page(i, 3 + i % 9)) for i in range(100, 160)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in blocks.extract(df, trained).collect()}
    assert all(got[i]["text"] == truth(i, 3 + i % 9) and got[i]["n_chars"] == len(got[i]["text"]) for i in range(100, 160))


def test_edge_cases(spark, trained):
    schema = "page_id long, url string, html string, text string, n_chars int"
    long = page(7, 4000)
    rows = [(1, None, None, "x", 1), (2, "u", "", "x", 1), (3, "u", "<script>x", "x", 1), (None, "u", page(5), "x", 1), (5, "u", page(5), "x", 1),
            (5, "u", page(5), "x", 1), (6, "u", long, "x", 1)]
    df = spark.createDataFrame(rows, schema)
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in blocks.extract(df, trained).collect()]
    assert [g for g in got if g[0] in (1, 2, 3)] == [(i, "", 0) for i in (1, 2, 3)]
    assert [g[1] for g in got if g[0] in (None, 5)] == [truth(5)] * 3
    assert [g[1] for g in got if g[0] == 6] == [truth(7, 4000)]
    empty = spark.createDataFrame([], schema)
    assert blocks.fit(empty) is None and blocks.extract(empty, None).collect() == []
    plain = blocks.extract(df, None).collect()  # without a network the markup decides
    assert {r["text"] for r in plain if r["page_id"] == 5} == {truth(5)}
