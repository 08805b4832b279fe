"""Titles, links, references and URL normal form: what a browser's DOM gives."""

import pytest
from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions import urls as U

LINKS = [
    ('<a href="http://x.example/?a=1&section=3&copy=2&region=de&amp;z=&copy;&lt=">', ["http://x.example/?a=1&section=3&copy=2&region=de&z=©&lt="]),
    ("<!-- <a href='http://no.example/'>--><a title='a>b' href=http://YES.example:80>x", ["http://yes.example/"]),
    ("<!--><a href=http://a.example/><!---><a href=http://b.example/><!-- --!><a href=http://c.example/>", ["http://a.example/", "http://b.example/", "http://c.example/"]),
    ('<script>"<a href=http://no.example/>"</scripty></script ><a href=http://a.example/>', ["http://a.example/"]),
    ("<textarea><a href=http://no.example/></textarea><style><a href=http://no.example/>", []),
    ('<base href="http://b.example/d/p"><a href="../u"><a href="./v/../w"><a href="../../../q/."><a href="?a=1"><a href="#f"><a href="//H.x/y"><a href="\\z\\t">'
     "<a href='mailto:a@b'><a href><a HREF = ' sp ace '>",
     ["http://b.example/d/p#f", "http://b.example/d/p?a=1", "http://b.example/d/sp%20ace", "http://b.example/d/w", "http://b.example/q/",
      "http://b.example/u", "http://b.example/z/t", "http://h.x/y"]),
    ('<base href="/rel"><a href="/x">q</a><a href="https://a.example:443/%2e%2E/b">', ["https://a.example/b"]),
    ('<base target=x><base href="http://one.example/"><base href="http://two.example/"><a href=k>', ["http://one.example/k"]),
    ('<a name=x href="http://a.example/y" href="http://a.example/z"><abbr href="http://n.example"><a data-href="http://n.example">', ["http://a.example/y"]),
    ("<a\nhref='http://a.example/p\n\tq'><A/href=http://c.example/>", ["http://a.example/pq", "http://c.example/"]),
    ('<a href="http://a.example/x', []),
    ("<a title='never closed href=http://a.example/> <a href=http://b.example/>", []),
    ("<a href='http://'><a href='http://:80/'><a href='https://u:p@H.example/#A b'><a href='http:///three.example'>",
     ["http://three.example/", "https://u:p@h.example/#A%20b"]),
    ("< a href=http://no.example/><a.b href=http://no.example/><?a href=http://no.example/?></ <a href=http://no.example/>>", []),
    ("", []), (None, None),
]


@pytest.mark.parametrize("html,links", LINKS)
def test_links_of_a_page(spark, html, links):
    got = spark.createDataFrame([(html,)], "h string").select(H.outlinks(F.col("h")).alias("l")).first()["l"]
    assert got == links


TITLES = [
    ("<!-- <title>no</title> --><title>yes</title>", "yes"), ("<svg><title>no</title></svg><title a='x>y'>y&amp;e <b>s </title>z", "y&e <b>s"),
    ("<svg><svg></svg><title>no</title></svg><TITLE>a\n b</TITLE><title>2</title>", "a b"), ("<svg/><title>k", "k"),
    ("<script>'<title>no</title>'</script><p title='<title>no</title>'>", ""), ("<title></title><title>2</title>", ""), ("<titles>no</titles>", ""),
    ("</svg><title>AT&ampT &copy2</title>", "AT&T ©2"), ("", ""), (None, None),
]


@pytest.mark.parametrize("html,title", TITLES)
def test_title_of_a_page(spark, html, title):
    assert spark.createDataFrame([(html,)], "h string").select(H.title(F.col("h")).alias("t")).first()["t"] == title


REFERENCES = [  # text, as text, as an attribute's value
    ("&notit; &notin; &amp;lt;", "¬it; ∉ &lt;", "&notit; ∉ &lt;"), ("a&copy=b&copy;=", "a©=b©=", "a&copy=b©="),
    ("&copy", "©", "©"), ("&copy!&copy1", "©!©1", "©!&copy1"), ("&#128;&#x80 &#129;", "€€ \x81", "€€ \x81"),
    ("&#1114112;&#99999999999;&#0;&#xD800;", "�" * 4, "�" * 4), ("&#x0000041;&#00000000065x", "AAx", "AAx"),
    ("&unknown; & &; &#; &#x; &", "&unknown; & &; &#; &#x; &", "&unknown; & &; &#; &#x; &"), ("none", "none", "none"), (None, None, None),
]


@pytest.mark.parametrize("text,as_text,as_value", REFERENCES)
def test_references_by_the_rule_of_their_place(spark, text, as_text, as_value):
    df = spark.createDataFrame([(text,)], "h string")
    assert tuple(df.select(H.unescape(F.col("h")), H.unescape(F.col("h"), attribute=True)).first()) == (as_text, as_value)


def test_references_match_the_standard_library(spark):
    """Every name of the table, with and without its semicolon, as text."""
    import html as std
    from html.entities import html5
    texts = [f"x&{k}" for k in html5] + [f"&{k};" for k in ("#1", "#x1F600", "amp;amp", "AMP")]
    got = {r["h"]: r["t"] for r in spark.createDataFrame([(t,) for t in texts], "h string").select("h", H.unescape(F.col("h")).alias("t")).collect()}
    assert {t: g for t, g in got.items() if g != std.unescape(t) and t != "&#1;"} == {}


def test_paths_without_dot_segments_match_a_stack(spark):
    import itertools
    paths = ["/" + "/".join(c) for n in range(1, 5) for c in itertools.product(["", ".", "..", "a", "%2E.", "..."], repeat=n)]

    def brute(path):
        out, parts = [], path[1:].split("/")
        for i, p in enumerate(parts):
            p = p.lower().replace("%2e", ".") if p.lower().replace("%2e", ".") in (".", "..") else p
            if p == "..":
                out = out[:-1]
            elif p != ".":
                out.append(p)
            if p in (".", "..") and i == len(parts) - 1:
                out.append("")
        return "/" + "/".join(out)

    got = {r["p"]: r["n"] for r in spark.createDataFrame([(p,) for p in paths], "p string").select("p", U.without_dots(F.col("p")).alias("n")).collect()}
    assert got == {p: brute(p) for p in paths}


def test_long_and_broken_pages_are_read_in_one_pass(spark):
    """Hundreds of thousands of unclosed tags, quotes and comments: no recursion, nothing read twice."""
    n = 200_000
    pages = ["<a " * n, "<a href='" + "x\"" * n, "<!--" * n, "<script>" + "</scrip" * n, "<title>" + "</titl" * n, "<p a" + " =b" * n + ">", "<" * n,
             "<a href=http://a.example/ " + "b=c " * n + ">"]
    got = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string").select("i", H.outlinks(F.col("h")).alias("l"), H.title(F.col("h"))).collect()
    assert {r["i"]: r["l"] for r in got}[7] == ["http://a.example/"]
