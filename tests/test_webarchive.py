"""The archive source: framing, adversarial members, exact splits, options."""

import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from trawl.operators.snapshot import to_snapshots
from trawl.sources import webarchive as W


def resp(status=200, ctype="text/html", body=b"<p>hello</p>", extra=""):
    head = f"HTTP/1.1 {status} X\r\n" + (f"Content-Type: {ctype}\r\n" if ctype else "") + extra
    return head, body


def warc(url, date="2012-09-30T11:13:27Z", rtype="response", status=200, ctype="text/html",
         body=b"<p>hello</p>", extra=""):
    head, body = resp(status, ctype, body, extra)
    return W.gzip_member(W.warc_record(url, date, rtype, head, body))


def write(path, members):
    path.write_bytes(b"".join(members))
    return str(path)


def scan(spark, path, **opts):
    return W.read_archive(spark, path, **opts)


def test_adversarial_members(spark, tmp_path):
    # a body holding the gzip magic, an empty body, a duplicate header, a
    # missing Content-Type, a bad and a fractional date, a non-response
    # record, then a truncated last member
    members = [
        warc("http://a.example/1", body=b"x\x1f\x8b\x08\x00junk" * 50),
        warc("http://a.example/2", body=b""),
        warc("http://a.example/3", extra="content-type: text/plain; charset=ISO-8859-1\r\n"),
        warc("http://a.example/4", ctype=None),
        warc("http://a.example/5", date="not-a-date"),
        warc("http://a.example/6", date="2012-09-30T11:13:27.5Z"),
        warc("http://a.example/7", rtype="request"),
    ]
    last = warc("http://a.example/8")
    p = write(tmp_path / "a.warc.gz", members + [last[: len(last) // 2]])
    rows = {r["url"] or "ERR": r for r in to_snapshots(scan(spark, p)).collect()}
    assert set(rows) == {f"http://a.example/{i}" for i in range(1, 8)} | {"ERR"}
    assert rows["http://a.example/1"]["content"] == b"x\x1f\x8b\x08\x00junk" * 50
    assert rows["http://a.example/2"]["content"] == b""
    assert rows["http://a.example/3"]["content_type"] == "text/plain; charset=ISO-8859-1"
    assert rows["http://a.example/4"]["mime"] == "no-type"
    assert rows["http://a.example/5"]["ts"] is None and rows["http://a.example/5"]["date_raw"] == "not-a-date"
    assert rows["http://a.example/6"]["ts"].microsecond == 500000
    assert rows["http://a.example/7"]["record_type"] == "request"
    assert rows["ERR"]["error"] == "truncated gzip member"


@pytest.mark.parametrize("split", [97, 512, 4096, 1 << 20])
def test_splits_read_every_member_once(spark, tmp_path, split):
    members = [warc(f"http://s.example/{i}", body=(b"\x1f\x8b\x08" + bytes([i % 251]) * (i * 7 % 900)))
               for i in range(300)]
    p = write(tmp_path / "s.warc.gz", members)
    df = scan(spark, p, maxPartitionBytes=split, openCostInBytes=0)
    urls = [r[0] for r in df.select("url").collect()]
    assert len(urls) == 300 and len(set(urls)) == 300


def test_arc_file_and_header_record(spark, tmp_path):
    head, body = resp()
    data = (W.gzip_member(W.arc_file_header("x.arc.gz"))
            + W.gzip_member(W.arc_record("http://b.example/", "20120930111327", "text/html", head, body))
            + W.gzip_member(W.arc_record("http://b.example/2", "201209301113", "text/html", head, body)))
    p = write(tmp_path / "x.arc.gz", [data])
    rows = to_snapshots(scan(spark, p, maxPartitionBytes=64, openCostInBytes=0)).orderBy("rec_offset").collect()
    assert [r["url"][:11] for r in rows] == ["filedesc://", "http://b.ex", "http://b.ex"]
    assert rows[1]["status"] == 200 and rows[1]["format"] == "arc" and rows[1]["content"] == body
    assert rows[2]["ts"].minute == 13 and rows[2]["ts"].second == 0
    kept = scan(spark, p, responsesOnly="true").count()
    assert kept == 2


def test_uncompressed_warc(spark, tmp_path):
    recs = [zlib.decompress(warc(f"http://u.example/{i}"), 31) for i in range(5)]
    p = write(tmp_path / "u.warc", recs)
    rows = scan(spark, p).orderBy("rec_offset").collect()
    assert [r["url"] for r in rows] == [f"http://u.example/{i}" for i in range(5)]
    assert len({r["rec_offset"] for r in rows}) == 5


def test_reader_options_and_pushdown(spark, tmp_path):
    members = [warc("http://o.example/a", status=200), warc("https://o.example/b", status=301),
               warc("https://o.example/c", status=200, ctype="image/png"),
               warc("https://o.example/d", rtype="warcinfo")]
    p = write(tmp_path / "o.warc.gz", members)
    got = {r[0] for r in scan(spark, p, urlPattern="https://.*", mimePattern="text/html",
                              status="SUCCESS").select("url").collect()}
    assert got == {"https://o.example/d"}  # warcinfo has no HTTP head, so no MIME/status to test
    pushed = scan(spark, p).where(F.col("record_type") == "response").where(F.col("url").startswith("https"))
    assert {r[0] for r in pushed.select("url").collect()} == {"https://o.example/b", "https://o.example/c"}


def test_content_cap_option(spark, tmp_path):
    p = write(tmp_path / "c.warc.gz", [warc("http://c.example/", body=b"y" * 5000)])
    row = scan(spark, p, maxContentBytes=100).first()
    assert row["content"] == b"y" * 100
    assert scan(spark, p, withContent="false").first()["content"] is None


def test_many_small_files_are_packed(spark, tmp_path):
    for i in range(20):
        write(tmp_path / f"f{i:02d}.warc.gz", [warc(f"http://p.example/{i}")])
    df = scan(spark, str(tmp_path), maxPartitionBytes=1 << 20, openCostInBytes=4096, minPartitions=1)
    assert df.count() == 20
    assert df.rdd.getNumPartitions() == 1
    # with the default 4 MiB open cost each file outweighs a 1 MiB split
    assert scan(spark, str(tmp_path), maxPartitionBytes=1 << 20, minPartitions=1).rdd.getNumPartitions() == 20
    # by default a small input is spread over the session's cores, as Spark's file sources do
    spread = scan(spark, str(tmp_path), maxPartitionBytes=1 << 20, openCostInBytes=4096)
    assert spread.count() == 20
    assert spread.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_gzip_module_reads_our_members(tmp_path):
    data = warc("http://g.example/") + warc("http://g.example/2")
    assert gzip.decompress(data).count(b"WARC/1.0") == 2


def test_uncompressed_arc_and_cap(spark, tmp_path):
    head, body = resp(body=b"z" * 3000)
    data = (W.arc_file_header("p.arc") + W.arc_record("http://p.example/1", "20120930111327", "text/html", head, body)
            + W.arc_record("http://p.example/2", "-", "text/html", head, body))
    p = write(tmp_path / "p.arc", [data])
    rows = scan(spark, p, maxContentBytes=10).orderBy("rec_offset").collect()
    assert [r["url"] for r in rows][1:] == ["http://p.example/1", "http://p.example/2"]
    assert rows[1]["content"] == b"z" * 10 and rows[2]["date_raw"] is None


@pytest.mark.parametrize("split", [150, 1000, 1 << 20])
def test_uncompressed_warc_splits_exactly_once(spark, tmp_path, split):
    # bodies that themselves contain a record separator and "WARC/1.0"
    recs = [zlib.decompress(warc(f"http://v.example/{i}", body=b"\r\n\r\nWARC/1.0\r\n" * (i % 4) + b"x" * (i * 13 % 700)), 31)
            for i in range(120)]
    p = write(tmp_path / "v.warc", recs)
    urls = [r[0] for r in scan(spark, p, maxPartitionBytes=split, openCostInBytes=0).select("url").collect()]
    assert sorted(urls) == sorted(f"http://v.example/{i}" for i in range(120))


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="does not exist"):
        scan(spark, str(tmp_path / "nope.warc.gz")).count()
    with pytest.raises(Exception, match="does not exist"):
        scan(spark, str(tmp_path / "*.warc.gz")).count()
