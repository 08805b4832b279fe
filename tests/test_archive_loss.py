"""The archive reader loses nothing: multi-record members, corrupt members and records, odd ARC headers, any cut."""

import gzip
import random
import re

import pytest

from trawl.sources import webarchive as W

HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"


def rec(i, size=200):
    return W.warc_record(f"http://x/{i}", "2012-09-30T11:13:27Z", "response", HEAD, (f"body {i} ".encode() * size)[:size])


def rows(path, split=None, cap=None):
    """All rows of a file read in ranges of ``split`` bytes, without Spark."""
    size = len(path.read_bytes())
    ends = range(0, size, split or size)
    out = []
    for a in ends:
        seg = W.Segment(str(path), a, min(a + (split or size), size), size)
        out += [(r["rec_offset"], r["rec_index"], r["url"], r["content"], (r["error"] or "")[:7]) for r in W._read_segment(seg, cap, False)]
    assert len({r[:2] for r in out}) == len(out)  # (offset, index) is unique
    return sorted(out, key=str)


SPLITS = [None, 97, 400, 1000, 5000]


@pytest.mark.parametrize("cap", [None, 10, 1 << 20])
def test_whole_file_gzip_keeps_every_record(tmp_path, cap):
    p = tmp_path / "a.warc.gz"
    p.write_bytes(gzip.compress(b"".join(rec(i, 2000) for i in range(500))))
    one = rows(p, None, cap)
    assert [r[2] for r in sorted(one)] == [f"http://x/{i}" for i in range(500)]
    assert {len(r[3]) for r in one} == {min(cap or 2000, 2000)}
    assert all(rows(p, s, cap) == one for s in (1000, 5000))


@pytest.mark.parametrize("damage", ["crc", "body", "magic", "cut"])
def test_a_corrupt_member_is_one_error_and_the_rest_is_read(tmp_path, damage):
    members = [bytearray(W.gzip_member(rec(i, 300 + i))) for i in range(12)]
    if damage == "crc":
        members[5][-6] ^= 1
    elif damage == "body":
        members[5][len(members[5]) // 2] ^= 0x55
    elif damage == "magic":
        members[5][1] ^= 0xFF
    else:
        members[5] = members[5][:-20]
    p = tmp_path / "a.warc.gz"
    p.write_bytes(b"".join(members))
    one = rows(p)
    assert {r[2] for r in one if not r[4]} >= {f"http://x/{i}" for i in range(12) if i != 5}
    assert sum(bool(r[4]) for r in one) == 1
    assert all(rows(p, s) == one for s in SPLITS)


@pytest.mark.parametrize("bad", [(3,), (3, 4), (0,), (9,), (2, 5, 6)])
def test_bad_records_of_plain_files(tmp_path, bad):
    parts = [rec(i, 50 + 30 * i) for i in range(10)]
    for i in bad:
        parts[i] = parts[i].replace(b"WARC/1.0", b"XXXX/1.0", 1)
    p = tmp_path / "a.warc"
    p.write_bytes(b"".join(parts))
    one = rows(p)
    good = {r[2] for r in one if not r[4]}
    assert good == {f"http://x/{i}" for i in range(10) if i not in bad}
    assert 1 <= sum(bool(r[4]) for r in one) <= len(bad)
    assert all(rows(p, s) == one for s in SPLITS)


def test_truncated_plain_file(tmp_path):
    p = tmp_path / "a.warc"
    p.write_bytes(rec(0) + rec(1)[:-50])
    assert [(r[2], r[4]) for r in rows(p)] == [("http://x/0", ""), ("http://x/1", "truncat")]


def test_odd_arc_headers_are_records_however_cut(tmp_path):
    r = random.Random(1)
    members = [W.gzip_member(W.arc_file_header("a.arc.gz"))]
    for i in range(200):
        url = f"http://a/{i}/" + "".join(r.choice("abcdef0123") for _ in range(6000 if i % 3 == 0 else 5))
        members.append(W.gzip_member(W.arc_record(url, ("2012", "20120930111327", "-")[i % 3], "text/html", HEAD, b"b" * (i * 7 % 500))))
    p = tmp_path / "a.arc.gz"
    p.write_bytes(b"".join(members))
    one = rows(p)
    assert len(one) == 201 and not any(x[4] for x in one)
    assert all(rows(p, s) == one for s in SPLITS)


def test_random_damage_never_depends_on_the_cut(tmp_path):
    for seed in range(25):
        r = random.Random(seed)
        data = bytearray(b"".join(W.gzip_member(rec(i, r.randint(0, 900))) for i in range(30)))
        for _ in range(r.randint(1, 4)):
            data[r.randrange(len(data))] ^= r.randint(1, 255)
        p = tmp_path / f"a{seed}.warc.gz"
        p.write_bytes(bytes(data))
        one = rows(p)
        assert all(rows(p, s) == one for s in SPLITS), seed
        assert sum(not x[4] for x in one) >= 30 - 8


def test_a_bomb_is_inflated_in_pieces(tmp_path):
    p = tmp_path / "a.warc.gz"
    p.write_bytes(W.gzip_member(rec(0, 100 << 20)))
    s = W._Member(W._Reader(p.open("rb"), p.stat().st_size), 0)
    most = 0
    s.take(400)
    while s.skip(1 << 20):
        most = max(most, len(s.buf))
    assert most <= W.INFLATE_PIECE and s.next_pos() == p.stat().st_size


@pytest.mark.parametrize("glob,want", [("*.warc.gz", {"a", "b"}), ("{a,c}.warc.gz", {"a"}), ("s*/[x-y].warc.gz", {"x"}), ("s?b", {"x", "z"}),
                                       ("[^a].warc.gz", {"b"}), ("*", {"a", "b", "x", "z"})])
def test_hadoop_globs(tmp_path, glob, want):
    (tmp_path / "sub").mkdir()
    for n in ("a", "b", "sub/x", "sub/z"):
        (tmp_path / f"{n}.warc.gz").write_bytes(W.gzip_member(rec(0)))
    (tmp_path / "_hidden").write_bytes(b"")
    assert {re.sub(r".*/|\.warc\.gz", "", f) for f, _ in W.list_files([f"{tmp_path}/{glob}"])} == want
    with pytest.raises(FileNotFoundError):
        W.list_files([f"{tmp_path}/*.nothing"])


def test_stores_by_their_hadoop_names():
    from pyarrow import fs as pafs
    try:
        fs, path = W._fs_and_path("s3a://bucket/crawl/a.warc.gz")
    except OSError as e:  # no region can be looked up without a network
        assert "bucket" in str(e)
    else:
        assert isinstance(fs, pafs.S3FileSystem) and path == "bucket/crawl/a.warc.gz"


def test_names_with_commas_and_columns(spark, tmp_path):
    p = tmp_path / "a,b.warc.gz"
    p.write_bytes(W.gzip_member(rec(0)) + W.gzip_member(rec(1)))
    assert W.read_archive(spark, [str(p)]).count() == 2
    narrow = W.read_archive(spark, str(p), columns=["url", "record_type"])
    assert narrow.columns == ["url", "record_type"] and narrow.count() == 2
    kept = W.read_archive(spark, str(p), urlPattern="http://x/0", keepFiltered="true")
    assert sorted((r["url"], r["content"] is None) for r in kept.collect()) == [("http://x/0", False), ("http://x/1", True)]
