"""Late extraction: records read by place, and the index job that reads only the winners' bodies."""

import gzip

import pytest
from pyspark.sql import functions as F

from trawl.plans import jobs
from trawl.session import Workspace
from trawl.sources import fetch
from trawl.sources import fixtures as fx
from trawl.sources import webarchive as W
from tests.conftest import SF_SMALL

HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"


def rec(i, body, url=None, date="2012-09-30T11:13:27Z"):
    return W.warc_record(url or f"http://x.example/{i}", date, "response", HEAD, body)


@pytest.mark.parametrize("kind", ["members", "whole", "plain", "arc"])
def test_any_record_is_found_at_its_place(spark, tmp_path, kind):
    recs = [rec(i, f"<p>body {i}</p>".encode() * (i % 7)) for i in range(60)]
    if kind == "arc":
        recs = [W.arc_file_header("a")] + [W.arc_record(f"http://x.example/{i}", "20120930111327", "text/html", HEAD, f"b{i}".encode()) for i in range(60)]
    data = {"members": b"".join(map(W.gzip_member, recs)), "whole": gzip.compress(b"".join(recs)), "plain": b"".join(recs),
            "arc": b"".join(map(W.gzip_member, recs))}[kind]
    (tmp_path / ("a." + ("arc.gz" if kind == "arc" else "warc" + ("" if kind == "plain" else ".gz")))).write_bytes(data)
    scan = W.read_archive(spark, str(tmp_path))
    some = scan.where(F.col("url").rlike("[147]$"))
    got = fetch.fetch_records(some.select(*fetch.PLACE))
    want = {tuple(r) for r in some.collect()}
    assert len(want) >= 18 and {tuple(r) for r in got.collect()} == want
    gone = spark.createDataFrame([(scan.first()["file"], 1, 0)], "file string, rec_offset long, rec_index int")
    assert [bool(r["error"]) for r in fetch.fetch_records(gone).collect()] == [True]


def _docs(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_late_documents_are_the_documents(spark, tmp_path, monkeypatch):
    """Recaptures under one id: later ones win, unless they have no article; the losers' bodies are not read."""
    page = lambda i, k: ("<html><body><p>" + f"capture {k} of page {i} says a good many words in one long paragraph " * 4 + "</p></body></html>").encode()
    files = {"a": [rec(i, page(i, 0)) for i in range(40)], "b": [rec(i, page(i, 1)) for i in range(0, 40, 2)],
             "c": [rec(i, b"<html></html>") for i in range(0, 40, 8)] + [rec(100, b"")], "d": [rec(0, page(0, 9))] * 30}
    for name, recs in files.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(b"".join(map(W.gzip_member, recs)))
    gaz = fx.gazetteer(spark, SF_SMALL)
    read = []
    real = jobs.fetch_records
    monkeypatch.setattr(jobs, "fetch_records", lambda places, cap: read.append(places.count()) or real(places, cap))
    with Workspace(spark) as ws:
        late = _docs(jobs.archive_documents(spark, str(tmp_path), gaz, ws=ws))
        plain = _docs(jobs.documents(W.read_archive(spark, str(tmp_path)), gaz, ws=ws))
    assert late == plain and len(late) == 40
    # 41 winners; then the other captures of the ids whose winner is empty (8, 16, 24, 32: two each; 100: none)
    assert read == [41, 8]


def test_late_documents_of_the_fixture(spark, tmp_path):
    path = W.write_archive(fx.capture_records(spark, SF_SMALL).drop("page_id"), str(tmp_path / "a"))
    gaz = fx.gazetteer(spark, SF_SMALL)
    with Workspace(spark) as ws:
        hints = fx.domain_hints(spark, SF_SMALL)
        late = jobs.archive_documents(spark, path, gaz, hints=hints, ws=ws)
        assert late.columns[-1] == "pub_date"
        assert _docs(late) == _docs(jobs.documents(W.read_archive(spark, path), gaz, hints=hints, ws=ws))
