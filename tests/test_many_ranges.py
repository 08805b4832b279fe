"""Small ranges of large archives: tasks and bytes read grow with the archive, not with the cuts."""

from collections import Counter

import pytest

from trawl.plans import queries as Q
from trawl.sources import fixtures as fx
from trawl.sources import webarchive as W


def members(n):
    return [W.gzip_member(W.warc_record(f"http://r.example/{i}", "2012-09-30T11:13:27Z", "response", "HTTP/1.1 200 X\r\n",
                                        b"\x1f\x8b\x08" + str(i).encode() * (i % 400))) for i in range(n)]


def test_small_ranges_share_a_task():
    size = 1 << 30
    for name in ("a.warc.gz", "a.warc"):
        parts = W.plan_partitions([(name, size)], 4096, 0, W.task_bytes([(name, size)], 4096, 8))
        assert len(parts) == size // W.TASK_BYTES
        assert sum(len(p.segments) for p in parts) == len(parts)  # what the driver holds grows with the tasks
        cuts = [(r.start, r.end) for p in parts for s in p.segments for r in s.ranges()]
        assert cuts == [(at, at + 4096) for at in range(0, size, 4096)]
    # a small input is still spread, and a range above the least is a task of its own
    assert W.task_bytes([("a.warc.gz", 80_000)], 4096, 8) == 10_000
    assert len(W.plan_partitions([("a.warc.gz", size)], 128 << 20, 0, W.task_bytes([("a.warc.gz", size)], 128 << 20, 8))) == 8


@pytest.mark.parametrize("kind", ["warc.gz", "warc"])
def test_ranges_of_a_task_read_their_bytes_once(tmp_path, monkeypatch, kind):
    import gzip
    got = members(3000)
    path = tmp_path / f"a.{kind}"
    path.write_bytes(b"".join(got if kind == "warc.gz" else map(gzip.decompress, got)))
    size, read = path.stat().st_size, []
    real = W._Reader.read

    def counted(self, pos, n):
        before = self.buf
        out = real(self, pos, n)
        read.append(len(self.buf) if self.buf is not before else 0)
        return out

    monkeypatch.setattr(W._Reader, "read", counted)
    rows = [r["url"] for r in W._read_segment(W.Segment(str(path), 0, size, size, 512), None, False)]
    assert rows == [f"http://r.example/{i}" for i in range(3000)]
    assert sum(read) < 3 * size
    alone = [r["url"] for a in range(0, size, 512) for r in W._read_segment(W.Segment(str(path), a, min(a + 512, size), size), None, False)]
    assert alone == rows


@pytest.mark.parametrize("kind", ["whole", "corrupt", "arc"])
def test_odd_archives_in_files_of_bounded_size(spark, tmp_path, monkeypatch, kind):
    """A task's records are not joined in memory; the rows are the same however many files there are."""
    sf = "/root/testdata/sf0.001"

    def rows(name):
        return Counter(tuple(r) for r in W.read_archive(spark, fx.odd_archive(spark, sf, str(tmp_path / name), kind))
                       .select("url", "date_raw", "http_head", "content", "error").collect())

    one = rows("one")
    monkeypatch.setattr(fx, "ODD_FILE_BYTES", 100_000)
    assert rows("many") == one
    assert len(list((tmp_path / "many").iterdir())) > len(list((tmp_path / "one").iterdir()))


def test_one_range_a_file_is_not_one_task(spark, monkeypatch):
    monkeypatch.setattr(fx, "ODD_FILE_BYTES", 10_000)
    monkeypatch.setattr(Q, "TASK_BYTES", 1)
    rows = Q._odd_rows(spark, "/root/testdata/sf0.001", "whole").where("setting like 'one%'")
    pages = fx.table(spark, "/root/testdata/sf0.001", "pages").count()
    assert rows.rdd.getNumPartitions() > 10 and rows.count() == 2 * pages
