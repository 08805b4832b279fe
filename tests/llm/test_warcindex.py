import hashlib
import random

import pytest
from pyspark.sql import functions as F

from trawl.llm import warcindex

SCHEMA = "page_id long, url string, html string, digest string, file string, ts string"


def test_loser_tree_merges():
    r = random.Random(0)
    for k in range(0, 9):
        runs = [sorted(r.randint(0, 50) for _ in range(r.randint(0, 30))) for _ in range(k)]
        assert list(warcindex.LoserTree(runs, lambda x: (x,))) == sorted(x for run in runs for x in run)


def data():
    big, same = "é" * 800, "<p>" + "x" * 2000
    rows = [(i, f"http://www.h{i % 3}.example.com/p{i % 5}?q={i}#f", f"page {i} " + "y" * (40 * i)) for i in range(60)]
    rows += [(100 + i, "https://Hot.Example.com:443/", same) for i in range(50)] + [(200, None, big), (201, "", big), (202, "x\ny", None), (203, "http://a/", "")]
    rows += [(204, "http://a/", "short"), (205, "http://a/", "short"), (None, "http://n/", same), (None, "http://n/", "only" * 400), (None, "http://n/", "only" * 400)]
    rows += [rows[3], (149, "http://again/", same)]
    return [(*r, "clash", "clash", "clash") for r in rows]


def brute(rows):
    keeper, count = {}, {}
    for p, _, h, *_ in rows:
        b = (h or "").encode()
        count[b] = count.get(b, 0) + 1
        if p is not None and len(b) >= 1000:
            keeper[b] = max(p, keeper.get(b, p))
    out = []
    for p, _, h, *_ in rows:
        b = (h or "").encode()
        k = keeper.get(b) if count[b] > 1 else None
        revisit = k is not None and p != k
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", k if revisit else None))
    return sorted(out, key=str)


def test_round_trip_and_global_order(spark, monkeypatch):
    monkeypatch.setattr(warcindex, "MERGE_ROWS", 10)
    df = spark.createDataFrame(data(), SCHEMA).repartition(5)
    got = warcindex.archive(df).collect()
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == brute(data())
    order = sorted(got, key=lambda r: r["position"])
    assert [r["position"] for r in order] == list(range(len(got)))
    keys = [(r["urlkey"], r["ts"], r["page_id"] is not None, r["page_id"] or 0) for r in order]
    assert keys == sorted(keys)


@pytest.mark.parametrize("url,key", [("http://www.Example.com/A?b#c", "com,example)/A?b"), ("https://h.de:443", "de,h)/"), (None, ")/"), ("x y", "x y)/")])
def test_url_key(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(warcindex.url_key(F.col("u"))).first()[0] == key


def test_damage_is_an_error_and_empty_table(spark):
    raw = warcindex.record(1, "http://a/", "20200101000000", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    assert warcindex.parse(raw)["payload_bytes"] == 3
    with pytest.raises(ValueError):
        warcindex.parse(raw.replace(b"abc\r\n\r\n", b"abd\r\n\r\n"))
    assert warcindex.archive(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_are_bounded_and_merge_all_the_same(spark, docs, monkeypatch):
    pages = docs.where("text is null or length(text) < 3000").selectExpr("doc_id as page_id", "concat('http://h', doc_id % 7, '.example/', doc_id) as url", "text as html")
    want = sorted(map(tuple, warcindex.archive(pages).collect()), key=str)
    monkeypatch.setattr(warcindex, "RUN_ROWS", 5)
    monkeypatch.setattr(warcindex, "MERGE_ROWS", 20)
    got = sorted(map(tuple, warcindex.archive(pages).collect()), key=str)
    cut = lambda rows: [(*r[:8],) for r in rows]
    assert cut(got) == cut(want) and sorted(r[8] for r in got) == list(range(len(want)))
