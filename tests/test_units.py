"""Unit tables (FIXTURES.md section 4) and single-column operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions import http
from trawl.functions.text import (date_lastwins, date_lastwins_pattern, date_mention, date_normalise,
                                  word_count)
from trawl.functions.urls import domain

DOMAINS = [
    ("http://www.spiegel.de/a", "spiegel.de"),
    ("https://user@WWW.Spiegel.de:80/a", "WWW.Spiegel.de"),
    ("http://news.www.x.de/", "www.x.de"),
    ("http://www2.x.de", "x.de"),
    ("http://awwwards.com/", "com"),
    ("dns:foo.de", None),
    ("httpfoo://x", None),
]


def one(spark, value, col_fn, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col_fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("url,expected", DOMAINS)
def test_domain(spark, url, expected):
    assert one(spark, url, domain) == expected


NORMALISE = [
    ("30.09.2012", "20120930000000"), ("2012/09/30", "20120930000000"), ("20120930", "20120930000000"),
    ("2012-09-30", "20120930000000"), ("1999-12-05", "19991205000000"), ("30/09/2012", "20120930000000"),
    ("05/12/1999", "19991205000000"), ("30-09-2012", "20120930000000"), ("30 09 2012", "20120930000000"),
    ("2012.09.30", "20120930000000"), ("31.02.2012", None), ("2012-09", None), ("2012/09", None),
    ("2012.09", None),
]


@pytest.mark.parametrize("text,expected", NORMALISE)
def test_date_normalise(spark, text, expected):
    assert one(spark, text, date_normalise) == expected


LASTWINS = [
    ("01/02/2003", dt.datetime(2003, 2, 1), "dd/MM/yyyy"),
    ("01/25/2003", dt.datetime(2003, 1, 25), "M/dd/yyyy"),
    ("25/01/2003", dt.datetime(2003, 1, 25), "dd/MM/yyyy"),
    ("30.09.2012", dt.datetime(2012, 9, 30), "dd.MM.yyyy"),
    ("30-09-2012", dt.datetime(2012, 9, 30), "dd-MM-yyyy"),
    ("2012-09-30", dt.datetime(2012, 9, 30), "yyyy-MM-dd"),
    ("2012/09/30", dt.datetime(2012, 9, 30), "yyyy/MM/dd"),
    ("2012.09.30", dt.datetime(2012, 9, 30), "yyyy.MM.dd"),
    ("20120930", dt.datetime(2012, 9, 30), "yyyyMMdd"),
    ("12-Mar-2012", dt.datetime(2012, 3, 12), "dd-MMM-yyyy"),
    ("1/2/2003 11:00:00 PM", dt.datetime(2003, 1, 2, 23), "M/dd/yyyy hh:mm:ss a"),
    ("no date", None, None),
]


@pytest.mark.parametrize("text,expected,pattern", LASTWINS)
def test_date_lastwins(spark, text, expected, pattern):
    row = spark.createDataFrame([(text,)], "v string").select(
        F.date_format(date_lastwins(F.col("v")), "yyyy-MM-dd HH:mm:ss").alias("d"),
        date_lastwins_pattern(F.col("v")).alias("p")).first()
    assert row["d"] == (expected.strftime("%Y-%m-%d %H:%M:%S") if expected else None)
    assert row["p"] == pattern


def test_date_mention_priority_not_position(spark):
    # pattern 2 (dd.mm.20yy) is tried before pattern 3 (19yy-mm-dd), whatever comes first
    assert one(spark, "1999-01-02 and 05.06.2011", date_mention) == "05.06.2011"
    assert one(spark, "nothing here", date_mention) is None


def test_word_count(spark):
    assert one(spark, " a  b\tc\nd\re\ff ", word_count) == 6
    assert one(spark, None, word_count) == 0


def test_title_and_visible_text(spark):
    page = ("<html><head><title> A &amp; B\n  c </title><style>x</style></head>"
            "<body><script>var a='<p>'</script><p>one &lt;two&gt;</p><!-- c --></body></html>")
    assert one(spark, page, H.title) == "A & B c"
    assert one(spark, page, H.visible_text) == "one <two>"


def test_outlinks_distinct_sorted_absolute_only(spark):
    page = '<a href="http://b/">1</a><a class=x href="https://a/">2</a><a href="/rel">3</a><a href="http://b/">4</a>'
    assert one(spark, page, H.outlinks) == ["http://b/", "https://a/"]


HEAD = ("HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\nX-A: 1\r\n"
        "content-TYPE: application/xhtml+xml; charset=windows-1252\r\n")


def test_headers_last_wins_case_insensitive(spark):
    assert one(spark, HEAD, http.status) == 404
    assert one(spark, HEAD, lambda c: http.header(c, "Content-Type")) == \
        "application/xhtml+xml; charset=windows-1252"
    assert one(spark, "HTP/1.1 200 OK\r\n", http.status) is None


@pytest.mark.parametrize("ct,mime,top", [
    ("text/html; charset=utf-8", "text/html", "text"), (None, "no-type", "unknown"),
    ("garbage", "garbage", "unknown"), ("Image/PNG", "Image/PNG", "image"),
])
def test_mime(spark, ct, mime, top):
    assert one(spark, ct, http.mime) == mime
    assert one(spark, mime, http.mime_top_level) == top


def test_charset_resolution_and_decode(spark):
    rows = [("text/html; charset=ISO-8859-1", "é".encode("utf-8")),
            ("text/html", '<meta charset="windows-1252">é'.encode("cp1252")),
            ("text/html", "é".encode("cp1252")),
            ("text/plain", "é".encode("utf-8")),
            ("text/html; charset=bogus-cs", "é".encode("utf-8"))]
    df = spark.createDataFrame(rows, "ct string, b binary")
    df = df.withColumn("cs", http.resolve_charset(F.col("ct"), F.col("b")))
    out = df.select("cs", http.decode_content(F.col("b"), F.col("cs")).alias("t")).collect()
    assert [r["cs"] for r in out] == ["ISO-8859-1", "WINDOWS-1252", "WINDOWS-1252", "UTF-8", "UTF-8"]
    assert out[0]["t"] == "Ã©" and out[1]["t"].endswith("é") and out[2]["t"] == "é"


def test_sniff_ignores_character_split_by_cap(spark):
    body = ("a" * 9 + "é").encode("utf-8")[:10]   # cut inside the 2-byte é
    assert one(spark, body, lambda c: http.sniffed_charset(c, F.lit(True)), "v binary") == "UTF-8"
    assert one(spark, body, http.sniffed_charset, "v binary") == "WINDOWS-1252"
    assert one(spark, b"caf\xe9", http.sniffed_charset, "v binary") == "WINDOWS-1252"


def test_late_meta_is_found(spark):
    page = b"<html><!--" + b"x" * 9000 + b"--><meta charset=iso-8859-5>\xd0"
    assert one(spark, page, http.meta_charset, "v binary") == "ISO-8859-5"


@pytest.mark.parametrize("text,expected", [
    ("M&uuml;nchen &#8211; &#x20AC;", "M\u00fcnchen \u2013 \u20ac"), ("&amp;lt; &amp &copy2 &nosuch; & &#0; &#xD800; &#150;", "&lt; & \u00a92 &nosuch; & \ufffd \ufffd \u2013"),
    ("&NotEqualTilde;&#128512;", "\u2242\u0338\U0001F600"), ("", ""), ("a&", "a&")])
def test_character_references(spark, text, expected):
    assert one(spark, text, H.unescape) == expected


@pytest.mark.parametrize("page", ["<" * 1_000_000, "<script>" * 60_000, "<!--" * 120_000, "<a href='x'>" * 40_000, "<title>" * 60_000, "<meta " * 80_000])
def test_hostile_markup_is_linear(spark, page):
    import time
    t = time.time()
    for fn in (H.title, H.visible_text, H.outlinks, lambda c: F.size(H.raw_blocks(c)), lambda c: F.length(H.anchor_html(c)),
               lambda c: http.meta_charset(c.cast("binary"))):
        one(spark, page, fn)
    assert time.time() - t < 20


def test_capture_time_shapes(spark):
    rows = [("warc", "2012-09-30T11:13:27Z"), ("warc", "2012-09-30T11:13:27.250Z"), ("warc", "bad"),
            ("arc", "20120930111327"), ("arc", "201209301113"), ("arc", "2012"), ("warc", None)]
    df = spark.createDataFrame(rows, "f string, d string")
    got = [r[0] for r in df.select(F.date_format(http.capture_time(F.col("f"), F.col("d")),
                                                 "yyyy-MM-dd HH:mm:ss.SSS")).collect()]
    assert got == ["2012-09-30 11:13:27.000", "2012-09-30 11:13:27.250", None,
                   "2012-09-30 11:13:27.000", "2012-09-30 11:13:00.000", None, None]
