"""``webarchive``: a Spark data source for WARC and ARC files.

    spark.read.format("webarchive").load("s3a://bucket/crawl/*.warc.gz")

One row per archive record, with the columns of ``RECORD_SCHEMA``; the
HTTP status, headers, MIME type and capture time are derived later by
built-in expressions (``operators.snapshot``). The reader only frames
records: gzip member -> archive record -> HTTP head / body.

Splitting (S2). A ``.gz`` archive is a series of gzip members, usually one
record each. The file is cut into byte ranges of ``maxPartitionBytes``; a range
owns every member whose header *starts* inside it. A range that does not
start at 0 scans forward to the first ``1f 8b 08`` whose trial inflate
yields a record header, so each member is read by exactly one range
however the file is cut (D1). A member running past the range end is
finished by the range that owns its start. Uncompressed WARC files are
cut the same way, a range syncing to the first record header after a
``\r\n\r\n`` whose Content-Length lands on the next record; uncompressed
ARC files are read whole. Small files are packed into one partition up to
``maxPartitionBytes``, counting ``openCostInBytes`` per file (S7). Ranges
below ``TASK_BYTES`` share a task with their neighbours, each still read for
itself, so the tasks grow with the bytes and not with the cuts.

Options (all optional):
  maxPartitionBytes   largest range, default 128 MiB
  openCostInBytes     packing cost per file, default 4 MiB
  taskBytes           most bytes of the ranges or small files that share a task
                      (one always fits); default maxPartitionBytes, but at
                      least 4 MiB or, if less, total bytes / minPartitions
  minPartitions       spread a small input over this many tasks (ranges
                      shrink to total bytes / minPartitions, as in Spark's
                      file sources); ``read_archive`` passes the session's
                      default parallelism
  urlPattern          keep records whose URL matches (whole string)  F2
  mimePattern         keep records whose MIME type matches           F3
  status              ALL (default) or SUCCESS (drop status >= 300)  F4
  responsesOnly       true: drop ARC file headers and non-response   F1
  keepFiltered        true: rows the filters above drop come back without
                      their body, so that a job can count them (A1)
  withContent         false: drop bodies (header-only scans); ``read_archive``
                      sets it from the columns asked for
  maxContentBytes     keep at most this many body bytes of each record (P10);
                      default: whole bodies
  ignoreCorruptFiles  true: a file that cannot be opened yields no rows
Reader errors never fail the task: each corrupt member, truncated record or
stretch that is no record comes back as one row with ``error`` set and the other
columns NULL where unknown (F7), and reading goes on behind it. ``rec_offset``
and ``rec_index`` (place within a gzip member) together are unique in a file.

Members are inflated and records framed in pieces of bounded size; only the
kept part of a body is held. Files are opened with ``pyarrow.fs``, so local
paths, HDFS and object stores (``s3a://`` and other Hadoop names) work alike. The writer (``df.write.format("webarchive")``) emits
one ``.warc.gz`` (and, for rows with ``format = 'arc'``, one ``.arc.gz``)
per task, one gzip member per record; it exists to build test archives.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In,
                                    InputPartition, IsNotNull, IsNull, StringStartsWith,
                                    WriterCommitMessage)

RECORD_SCHEMA = ("file string, rec_offset long, rec_index int, format string, record_type string, url string, "
                 "date_raw string, http_head string, content binary, error string")
FIELDS = ["file", "rec_offset", "rec_index", "format", "record_type", "url", "date_raw", "http_head", "content", "error"]

GZIP_MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
INFLATE_PIECE = 1 << 18   # most bytes inflated at once
DEFLATE_PIECE = 1 << 14   # bytes read at once
LEAST_WINDOW = 1 << 18    # bytes buffered of a file, for a small range too
DEFAULT_SPLIT = 128 << 20
DEFAULT_OPEN_COST = 4 << 20
TASK_BYTES = 4 << 20      # adjacent ranges up to this much share a task
BATCH_ROWS = 1024
BATCH_BYTES = 64 << 20
# Longest record header or HTTP head that is looked for.
HEADER_LIMIT = 1 << 20
# Columns the reader can evaluate pushed predicates on.
PUSHABLE = {"file", "format", "record_type", "url"}


# ---- file system ----------------------------------------------------------------

# Hadoop's names of stores that pyarrow knows by another one.
SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3"}
LIST_THREADS = 16


def _fs_and_path(uri: str):
    """(pyarrow file system, path in it) of a local path or a Hadoop-style URI:
    file, hdfs, viewfs, s3, s3a, gs, abfs, abfss."""
    from pyarrow import fs as pafs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    scheme, sep, rest = uri.partition("://")
    if sep and scheme in SCHEME_ALIASES:
        uri = f"{SCHEME_ALIASES[scheme]}://{rest}"
    return pafs.FileSystem.from_uri(uri)


def glob_regex(pattern: str) -> re.Pattern:
    """Hadoop's glob as a regular expression over whole paths: ``*`` and ``?``
    stay within a name, ``[a-c]`` and ``[^a]`` are classes, ``{a,b}`` are
    alternatives, a backslash quotes. What lies below a match matches too."""
    out, i, braces = [], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and "]" in pattern[i + 2:]:
            end = pattern.index("]", i + 2)
            body = pattern[i + 1: end]
            neg = body[0] in "^!"
            out.append("[" + ("^/" if neg else "") + re.escape(body[neg:]).replace(r"\-", "-") + "]")
            i = end
        elif c == "{":
            out.append("(?:")
            braces += 1
        elif c == "}" and braces:
            out.append(")")
            braces -= 1
        elif c == "," and braces:
            out.append("|")
        elif c == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        else:
            out.append(re.escape(c))
        i += 1
    return re.compile("".join(out) + "(?:/.*)?")


def _files_below(fs, root: str) -> list:
    """All files below ``root``, its subfolders listed side by side."""
    from concurrent.futures import ThreadPoolExecutor

    from pyarrow import fs as pafs
    files, folders = [], [root]
    with ThreadPoolExecutor(LIST_THREADS) as pool:
        while folders:
            found = [i for infos in pool.map(lambda d: fs.get_file_info(pafs.FileSelector(d)), folders) for i in infos
                     if not i.base_name.startswith((".", "_"))]  # hidden, as in Spark's file sources
            files += [i for i in found if i.type == pafs.FileType.File]
            folders = [i.path for i in found if i.type == pafs.FileType.Directory]
    return files


def list_files(paths: list[str]) -> list[tuple[str, int]]:
    """(uri, size) of the archive files under each path (file, folder or glob).
    A path or glob that matches nothing is an error, as in Spark's file sources."""
    from pyarrow import fs as pafs
    out = set()
    for p in paths:
        base, pattern = p, None
        if (at := min((p.find(c) for c in "*?[{" if c in p), default=-1)) >= 0 and not _exists(p):
            base, pattern = p[:at].rsplit("/", 1)[0], glob_regex(p.split("://")[-1] if "://" in p else p)
        fs, root = _fs_and_path(base)
        prefix = base[: len(base) - len(root)] if base.endswith(root) else ""
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.Directory:
            infos = _files_below(fs, root)
        else:
            infos = [info] if info.type == pafs.FileType.File and pattern is None else []
        found = [(prefix + i.path, i.size) for i in infos]
        if pattern is not None:
            found = [x for x in found if pattern.fullmatch(x[0].split("://")[-1])]
        if not found and (pattern is not None or info.type == pafs.FileType.NotFound):
            raise FileNotFoundError(f"archive path does not exist: {p}")
        out.update(found)
    return sorted(out)


def _exists(p: str) -> bool:
    """True for a file whose name holds glob characters."""
    from pyarrow import fs as pafs
    try:
        fs, root = _fs_and_path(p)
        return fs.get_file_info(root).type != pafs.FileType.NotFound
    except (ValueError, OSError):
        return False


def archive_format(name: str) -> str:
    n = name.lower()
    return "arc" if n.endswith((".arc", ".arc.gz")) else "warc"


# ---- splits -------------------------------------------------------------------------

@dataclass(frozen=True)
class Segment:
    path: str
    start: int
    end: int          # exclusive; a member starting before it is read to its end
    size: int
    split: int = 0    # ranges of so many bytes, one behind the other; 0: one range

    def ranges(self):
        step = self.split or max(self.end - self.start, 1)
        for at in range(self.start, max(self.end, self.start + 1), step):
            yield Segment(self.path, at, min(at + step, self.end), self.size)


class ArchivePartition(InputPartition):
    def __init__(self, segments: list[Segment]):
        super().__init__(segments)
        self.segments = segments


def split_bytes(files: list[tuple[str, int]], max_split: int, open_cost: int, min_partitions: int) -> int:
    """Range size, as Spark's file sources choose it: at most
    ``max_split``, but small enough that the input spreads over
    ``min_partitions`` tasks (never below ``open_cost``)."""
    total = sum(size + open_cost for _, size in files)
    per_task = total // max(min_partitions, 1)
    return max(1, min(max_split, max(open_cost, per_task)))


def task_bytes(files: list[tuple[str, int]], split: int, min_partitions: int) -> int:
    """Bytes of the ranges that share a task: one range, or neighbours up to ``TASK_BYTES`` as long as there are ``min_partitions`` tasks."""
    total = sum(size for _, size in files)
    return max(split, min(TASK_BYTES, total // max(min_partitions, 1)))


def plan_partitions(files: list[tuple[str, int]], split: int, open_cost: int, task: int | None = None) -> list[ArchivePartition]:
    """Cut gzip and plain WARC files into ranges of ``split`` bytes, neighbours up to ``task`` bytes in one task;
    pack small files (S7). What is planned grows with the tasks, however small the ranges are."""
    task = task or split
    run = max(1, task // split) * split
    big, small = [], []
    for path, size in files:
        splittable = path.lower().endswith((".gz", ".warc"))
        if splittable and size > split:
            for start in range(0, size, run):
                big.append(ArchivePartition([Segment(path, start, min(start + run, size), size, split)]))
        else:
            small.append(Segment(path, 0, size, size))
    packed, cur, cur_bytes = [], [], 0
    for seg in sorted(small, key=lambda s: -s.size):
        cost = seg.size + open_cost
        if cur and cur_bytes + cost > task:
            packed.append(ArchivePartition(cur))
            cur, cur_bytes = [], 0
        cur.append(seg)
        cur_bytes += cost
    if cur:
        packed.append(ArchivePartition(cur))
    return big + packed


# ---- byte streams ------------------------------------------------------------------

class _Reader:
    """Positional reads through one buffered window, so walking many small
    members costs one sequential pass over the file, not a read per member."""

    def __init__(self, f, size: int, window: int = 4 * CHUNK):
        self.f, self.size, self.window = f, size, window
        self.buf_start, self.buf = 0, b""

    def read(self, pos: int, n: int) -> bytes:
        n = min(n, max(self.size - pos, 0))
        end = pos + n
        if not (self.buf_start <= pos and end <= self.buf_start + len(self.buf)):
            self.f.seek(pos)
            self.buf_start = pos
            self.buf = self.f.read(min(max(n, self.window), self.size - pos))
        off = pos - self.buf_start
        return self.buf[off: off + n]


class _Stream:
    """Bytes handed out in order. ``failure`` says why they ended early."""

    def __init__(self):
        self.buf, self.failure, self.ended = bytearray(), None, False

    def _more(self) -> bytes:
        raise NotImplementedError

    def _fill(self, n: int) -> bool:
        """Buffers ``n`` bytes if there are as many."""
        while len(self.buf) < n and not self.ended:
            piece = self._more()
            if piece:
                self.buf += piece
        return len(self.buf) >= n

    def peek(self, n: int) -> bytes:
        self._fill(n)
        return bytes(self.buf[:n])

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer if the stream ends."""
        self._fill(n)
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out

    def skip(self, n: int) -> int:
        """Drops up to ``n`` bytes; returns how many there were."""
        left = n
        while left:
            if not self.buf and not self._fill(1):
                break
            k = min(left, len(self.buf))
            del self.buf[:k]
            left -= k
        return n - left

    def until(self, sep: bytes, most: int) -> bytes | None:
        """Bytes up to and with ``sep`` if it ends within ``most`` bytes; else None, nothing taken."""
        seen = 0
        while True:
            i = self.buf.find(sep, max(0, seen - len(sep) + 1), most)
            if i >= 0:
                return self.take(i + len(sep))
            seen = len(self.buf)
            if seen >= most or not self._fill(min(most, max(2 * seen, 1024))) and len(self.buf) == seen:
                return None

    def drain(self) -> None:
        while self.skip(CHUNK) == CHUNK:
            pass


class _Member(_Stream):
    """One gzip member, inflated in pieces of bounded size."""

    def __init__(self, r: _Reader, pos: int):
        super().__init__()
        self.r, self.at, self.d = r, pos, zlib.decompressobj(31)

    def _inflate(self, data: bytes) -> bytes:
        before = self.d.copy()
        try:
            return self.d.decompress(data, INFLATE_PIECE)
        except zlib.error as e:
            self.failure, self.ended = f"corrupt gzip member: {e}", True
        # what comes before the bad byte is still good
        out, at, step = bytearray(), 0, len(data)
        while step and at < len(data):
            tried = before.copy()
            try:
                out += tried.decompress(data[at: at + step])
                before, at = tried, at + step
            except zlib.error:
                step //= 2
        return bytes(out)

    def _more(self) -> bytes:
        if self.d.eof:
            self.ended = True
            return b""
        data = self.d.unconsumed_tail
        if not data:
            data = self.r.read(self.at, DEFLATE_PIECE)
            self.at += len(data)
            if not data:
                self.failure, self.ended = "truncated gzip member", True
                return b""
        return self._inflate(data)

    def next_pos(self) -> int | None:
        """Where the next member starts; None if this one broke off."""
        self.drain()
        return None if self.failure else self.at - len(self.d.unused_data)


class _Plain(_Stream):
    """An uncompressed file from ``pos`` on; skipping does not read."""

    def __init__(self, r: _Reader, pos: int):
        super().__init__()
        self.r, self.at = r, pos

    def _more(self) -> bytes:
        data = self.r.read(self.at, DEFLATE_PIECE)
        self.at += len(data)
        self.ended = not data
        return data

    def skip(self, n: int) -> int:
        k = min(n, len(self.buf))
        del self.buf[:k]
        far = min(n - k, self.r.size - self.at)
        self.at += far
        return k + far

    def pos(self) -> int:
        return self.at - len(self.buf)


# ---- records -------------------------------------------------------------------------

class _Unparseable(Exception):
    pass


_WARC_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$")
# ARC header line: URL, more fields, length.
_ARC_LINE = re.compile(rb"^[^ \r\n]+ (?:[^\r\n]* )?[0-9]+\r?$")


def _warc_header(s: _Stream) -> tuple[dict, int]:
    raw = s.until(b"\r\n\r\n", HEADER_LIMIT)
    if raw is None or not raw.startswith(b"WARC/"):
        raise _Unparseable("not a WARC record header")
    headers = {}
    for line in raw.split(b"\r\n")[1:]:
        k, sep, v = line.partition(b":")
        if sep:
            headers[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    try:
        length = int(headers.get("content-length", "0"))
    except ValueError:
        raise _Unparseable("bad Content-Length") from None
    rtype = headers.get("warc-type")
    http = rtype in ("response", "request", "revisit") or headers.get("content-type", "").lower().startswith("application/http")
    return {"format": "warc", "record_type": rtype, "url": headers.get("warc-target-uri"),
            "date_raw": headers.get("warc-date"), "http": http}, length


def _arc_header(s: _Stream) -> tuple[dict, int]:
    raw = s.until(b"\n", HEADER_LIMIT)
    fields = raw.rstrip(b"\r\n").decode("utf-8", "replace").split(" ") if raw is not None else []
    if len(fields) < 5 or not fields[-1].isdigit():
        raise _Unparseable("bad ARC header line")
    url = fields[0]
    return {"format": "arc", "record_type": None, "url": url, "date_raw": fields[2] if fields[2] not in ("", "-") else None,
            "http": not url.startswith("filedesc://")}, int(fields[-1])


def _http_head(s: _Stream, length: int) -> tuple[str | None, int]:
    """The HTTP head through its last header line, and the bytes taken for
    it. Without a blank line within the header limit there is none. A malformed
    status line is kept as is; its status comes out NULL and the record is
    quarantined downstream."""
    most = min(length, HEADER_LIMIT)
    probe = s.peek(min(most, 4096))
    if probe.find(b"\n\r\n") < 0 and probe.find(b"\n\n") < 0 and most > len(probe):
        probe = s.peek(most)
    crlf, lf = probe.find(b"\r\n\r\n"), probe.find(b"\n\n")
    if crlf >= 0:
        s.skip(crlf + 4)
        return probe[: crlf + 2].decode("latin-1"), crlf + 4
    if lf >= 0:
        s.skip(lf + 2)
        return probe[: lf + 1].decode("latin-1"), lf + 2
    return None, 0


def _record(s: _Stream, fmt: str, cap: int | None) -> dict:
    """The record at the stream's position. At most ``cap`` bytes of its body are
    kept, the rest is passed over. A record that breaks off carries ``error``."""
    rec, length = _arc_header(s) if fmt == "arc" else _warc_header(s)
    head, used = _http_head(s, length) if rec.pop("http") else (None, 0)
    body = length - used
    keep = body if cap is None else min(body, cap)
    content = s.take(keep)
    got = len(content) + s.skip(body - len(content))
    rec.update(http_head=head, content=content, error=None if got == body else s.failure or "truncated record")
    return rec


def _at_end(s: _Stream) -> bool:
    """Passes over blank lines between records; True if nothing follows."""
    while (c := s.peek(1)) in (b"\r", b"\n"):
        s.skip(1)
    return not c


def _records(s: _Stream, path: str, offset: int, fmt: str, cap: int | None):
    """Rows of one gzip member: its records, and an error row if it breaks off
    or holds something else. Records and errors number on in ``rec_index``."""
    index, told = 0, False
    try:
        while not _at_end(s):
            rec = _record(s, fmt, cap)
            told = rec["error"] is not None
            yield {**rec, "file": path, "rec_offset": offset, "rec_index": index}
            index += 1
    except _Unparseable as e:
        told = True
        yield _error_row(path, offset, index, fmt, s.failure or f"unparseable record: {e}")
        index += 1
        s.drain()
    if s.failure and not told:
        yield _error_row(path, offset, index, fmt, s.failure)


# ---- where a range begins ---------------------------------------------------------------

def _valid_member_at(r: _Reader, pos: int, fmt: str) -> bool:
    """A gzip member that inflates to the beginning of a record."""
    if r.read(pos, 3) != GZIP_MAGIC:
        return False
    s = _Member(r, pos)
    if fmt == "warc":
        return bool(re.match(rb"WARC/[0-9]", s.peek(8)))
    line = s.until(b"\n", HEADER_LIMIT)
    return line is not None and bool(_ARC_LINE.match(line.rstrip(b"\n")))


def sync_to_member(r: _Reader, start: int, end: int, fmt: str) -> int | None:
    """Offset of the first real gzip member header in [start, end), or None."""
    pos = start
    while pos < end:
        buf = r.read(pos, min(LEAST_WINDOW, end - pos) + 2)
        if not buf:
            return None
        i = buf.find(GZIP_MAGIC)
        while i >= 0:
            cand = pos + i
            if cand >= end:
                return None
            if _valid_member_at(r, cand, fmt):
                return cand
            i = buf.find(GZIP_MAGIC, i + 1)
        pos += max(len(buf) - 2, 1)
    return None


# ---- reader ----------------------------------------------------------------------------

class _Filters:
    def __init__(self, options: dict, pushed: list):
        self.url = re.compile(options["urlPattern"]) if options.get("urlPattern") else None
        self.mime = re.compile(options["mimePattern"]) if options.get("mimePattern") else None
        self.success = str(options.get("status", "ALL")).upper() == "SUCCESS"
        self.responses_only = str(options.get("responsesOnly", "false")).lower() == "true"
        self.pushed = pushed

    def pushed_ok(self, rec: dict) -> bool:
        return all(_eval_pushed(f, rec) for f in self.pushed)

    def keep(self, rec: dict) -> bool:
        if rec.get("error"):
            return True
        fmt, url, rtype = rec["format"], rec["url"], rec["record_type"]
        header = (fmt == "arc" and (url is None or url.startswith("filedesc://"))) or \
                 (rtype is not None and rtype != "response")
        if self.responses_only and header:
            return False
        if self.url is not None and not (url is not None and self.url.fullmatch(url)):
            return False
        if self.mime is not None or self.success:
            status, ctype = _status_and_type(rec["http_head"])
            if self.mime is not None and not self.mime.fullmatch(_truncate_mime(ctype)):
                return False
            if self.success and status is not None and status >= 300:
                return False
        return True


_STATUS = re.compile(r"^HTTP/[^ \t]+[ \t]+([0-9]{3})")


def _status_and_type(head: str | None):
    if not head:
        return None, None
    m = _STATUS.match(head)
    ctype = None
    for line in head.split("\n")[1:]:
        k, sep, v = line.partition(":")
        if sep and k.strip().lower() == "content-type":
            ctype = v.strip()
    return (int(m.group(1)) if m else None), ctype


def _truncate_mime(ctype: str | None) -> str:
    m = re.match(r"^[ \t]*([^ \t;,]+)", ctype or "")
    return m.group(1) if m else "no-type"


def _eval_pushed(f, rec: dict) -> bool:
    col = f.attribute[0]
    v = rec.get(col)
    if isinstance(f, EqualTo):
        return v is not None and v == f.value
    if isinstance(f, In):
        return v is not None and v in f.value
    if isinstance(f, IsNotNull):
        return v is not None
    if isinstance(f, IsNull):
        return v is None
    if isinstance(f, StringStartsWith):
        return v is not None and v.startswith(f.value)
    return True


class WebArchiveReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.options = options
        self.pushed = []

    def pushFilters(self, filters):
        for f in filters:
            ok = (isinstance(f, (EqualTo, In, IsNotNull, IsNull, StringStartsWith))
                  and len(f.attribute) == 1 and f.attribute[0] in PUSHABLE)
            if ok:
                self.pushed.append(f)
            else:
                yield f

    def partitions(self):
        paths = [self.options["path"]] if self.options.get("path") else []
        paths += json.loads(self.options.get("paths") or "[]")  # as Spark hands over load([...])
        files = list_files(paths)
        cost = int(self.options.get("openCostInBytes", DEFAULT_OPEN_COST))
        split = split_bytes(files, int(self.options.get("maxPartitionBytes", DEFAULT_SPLIT)), cost,
                            int(self.options.get("minPartitions", 1)))
        task = int(self.options.get("taskBytes") or task_bytes(files, split, int(self.options.get("minPartitions", 1))))
        parts = plan_partitions(files, split, cost, task)
        return parts or [ArchivePartition([])]

    def read(self, partition: ArchivePartition):
        import pyarrow as pa
        filters = _Filters(self.options, self.pushed)
        with_content = str(self.options.get("withContent", "true")).lower() != "false"
        cap = self.options.get("maxContentBytes")
        cap = 0 if not with_content else int(cap) if cap not in (None, "") else None
        keep_filtered = str(self.options.get("keepFiltered", "false")).lower() == "true"
        ignore_corrupt = str(self.options.get("ignoreCorruptFiles", "false")).lower() == "true"
        cols = {k: [] for k in FIELDS}
        nbytes = 0
        for seg in partition.segments:
            for rec in _read_segment(seg, cap, ignore_corrupt):
                if not filters.pushed_ok(rec):
                    continue
                passed = filters.keep(rec)
                if not passed and not keep_filtered:
                    continue
                body = rec.get("content") if with_content and passed else None
                rec["content"] = body
                for k in FIELDS:
                    cols[k].append(rec.get(k))
                nbytes += len(body or b"")
                if len(cols["file"]) >= BATCH_ROWS or nbytes >= BATCH_BYTES:
                    yield _batch(pa, cols)
                    cols = {k: [] for k in FIELDS}
                    nbytes = 0
        if cols["file"]:
            yield _batch(pa, cols)


_ARROW_TYPES = None


def _batch(pa, cols):
    global _ARROW_TYPES
    if _ARROW_TYPES is None:
        s, l, b = pa.string(), pa.int64(), pa.binary()
        _ARROW_TYPES = {"file": s, "rec_offset": l, "rec_index": pa.int32(), "format": s, "record_type": s, "url": s,
                        "date_raw": s, "http_head": s, "content": b, "error": s}
    return pa.RecordBatch.from_arrays([pa.array(cols[k], type=_ARROW_TYPES[k]) for k in FIELDS], names=FIELDS)


def _read_segment(seg: Segment, cap: int | None, ignore_corrupt: bool):
    fmt = archive_format(seg.path.removesuffix(".gz"))
    try:
        fs, p = _fs_and_path(seg.path)
        f = fs.open_input_file(p)
    except Exception as e:  # noqa: BLE001
        if not ignore_corrupt:
            yield _error_row(seg.path, seg.start, 0, fmt, f"cannot open: {e}")
        return
    with f:
        r = _Reader(f, seg.size, min(4 * CHUNK, max(seg.end - seg.start, LEAST_WINDOW)))
        read = _read_gzip if seg.path.lower().endswith(".gz") else _read_plain
        for one in seg.ranges():
            yield from read(r, one, fmt, cap)


def _read_gzip(r: _Reader, seg: Segment, fmt: str, cap: int | None):
    """A range owns the members that start in it and look like a record, and
    whatever follows them directly and does not: a range after it can only
    begin at a member that does. So each row is read once, however the file is cut."""
    pos = seg.start if seg.start == 0 else sync_to_member(r, seg.start, seg.end, fmt)
    while pos is not None and pos < r.size and (pos < seg.end or not _valid_member_at(r, pos, fmt)):
        s = _Member(r, pos)
        yield from _records(s, seg.path, pos, fmt, cap)
        nxt = s.next_pos()
        # corrupt or truncated: resume at the next real member, if any
        pos = nxt if nxt is not None else sync_to_member(r, pos + 1, max(seg.end, pos + 1), fmt)


def _plain_warc_record_at(r: _Reader, pos: int) -> bool:
    """A WARC record header with a Content-Length, and a block that ends exactly at
    a record separator followed by another record or the end of file."""
    s = _Plain(r, pos)
    raw = s.until(b"\r\n\r\n", HEADER_LIMIT)
    if raw is None or not raw.startswith(b"WARC/1."):
        return False
    m = _WARC_LENGTH.search(raw)
    if not m:
        return False
    tail = r.read(pos + len(raw) + int(m.group(1)), 9)
    return tail[:4] == b"\r\n\r\n" and (len(tail) == 4 or tail[4:] == b"WARC/")


def sync_to_plain_record(r: _Reader, start: int, end: int) -> int | None:
    """First offset in [start, end) where a validated WARC record starts
    right after a record separator (which may begin before ``start``)."""
    pos = max(start - 4, 0)
    while pos < end:
        buf = r.read(pos, min(LEAST_WINDOW, end - pos) + 16)
        if not buf:
            return None
        i = buf.find(b"\r\n\r\nWARC/1.")
        while i >= 0:
            cand = pos + i + 4
            if cand >= end:
                return None
            if cand >= start and _plain_warc_record_at(r, cand):
                return cand
            i = buf.find(b"\r\n\r\nWARC/1.", i + 1)
        pos += max(len(buf) - 16, 1)
    return None


def _read_plain(r: _Reader, seg: Segment, fmt: str, cap: int | None):
    """Uncompressed archive, one record at a time; what is not kept of a block is
    jumped over. A WARC range owns its records as a gzip range its members.
    Something that is no record gives one error row, and reading goes on at
    the next validated record (WARC; an ARC file ends there)."""
    pos = 0 if seg.start == 0 else sync_to_plain_record(r, seg.start, seg.end)
    while pos is not None and pos < r.size:
        s = _Plain(r, pos)
        if _at_end(s):
            return
        pos = s.pos()
        if pos >= seg.end and (fmt == "arc" or _plain_warc_record_at(r, pos)):
            return  # the next range begins here
        try:
            rec = _record(s, fmt, cap)
            if fmt == "warc" and rec["error"] is None and s.peek(4) not in (b"\r\n\r\n", b""):
                raise _Unparseable("block does not end at a record separator")
            yield {**rec, "file": seg.path, "rec_offset": pos, "rec_index": 0}
            pos = s.pos()
        except _Unparseable as e:
            yield _error_row(seg.path, pos, 0, fmt, f"unparseable record: {e}")
            pos = sync_to_plain_record(r, pos + 1, max(seg.end, pos + 1)) if fmt == "warc" else None


def _error_row(path, offset, index, fmt, msg):
    return {"file": path, "rec_offset": offset, "rec_index": index, "format": fmt, "record_type": None, "url": None,
            "date_raw": None, "http_head": None, "content": None, "error": msg}


# ---- writer ------------------------------------------------------------------------------

class _Commit(WriterCommitMessage):
    def __init__(self, files):
        self.files = files


STAGING = "_staging"


def warc_record(url, date_raw, record_type, http_head, content) -> bytes:
    payload = ((http_head or "").encode("latin-1") + (b"\r\n" if http_head is not None else b"")
               + (content or b""))
    rid = uuid.uuid5(uuid.NAMESPACE_URL, f"{url}|{date_raw}|{record_type}")
    lines = ["WARC/1.0", f"WARC-Type: {record_type or 'response'}", f"WARC-Record-ID: <urn:uuid:{rid}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {url}")
    if date_raw is not None:
        lines.append(f"WARC-Date: {date_raw}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(payload)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + payload + b"\r\n\r\n"


def mime_of_head(head: str | None) -> str:
    """Last Content-Type of an HTTP head without parameters ('no-type' if
    absent); ARC header fields cannot hold spaces."""
    _, ctype = _status_and_type(head)
    bare = (ctype or "").split(";")[0].strip().split(" ")[0]
    return bare or "no-type"


def arc_record(url, date_raw, mime, http_head, content) -> bytes:
    payload = ((http_head or "").encode("latin-1") + (b"\r\n" if http_head is not None else b"")
               + (content or b""))
    line = f"{url} 0.0.0.0 {date_raw or '-'} {mime or 'no-type'} {len(payload)}\n"
    return line.encode("utf-8") + payload + b"\n"


def arc_file_header(name: str) -> bytes:
    body = b"1 0 trawl\nURL IP-address Archive-date Content-type Archive-length\n"
    return f"filedesc://{name} 0.0.0.0 - text/plain {len(body)}\n".encode() + body + b"\n"


def gzip_member(data: bytes) -> bytes:
    buf = io.BytesIO()
    with gzip.GzipFile(fileobj=buf, mode="wb", mtime=0) as g:
        g.write(data)
    return buf.getvalue()


class WebArchiveWriter(DataSourceWriter):
    """Each task writes under ``<path>/_staging``; the driver's ``commit``
    moves the files of the successful attempts into ``<path>``, so a task
    retried after an executor loss leaves no partial or duplicate file
    among the visible ones. ``abort`` removes what was staged."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite

    def write(self, rows):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        tag = f"part-{ctx.partitionId():05d}-{ctx.attemptNumber()}-{uuid.uuid4().hex[:8]}" if ctx else uuid.uuid4().hex
        fs, base = _fs_and_path(self.path)
        staging = f"{base}/{STAGING}"
        fs.create_dir(staging, recursive=True)
        outs, files = {}, []
        try:
            for row in rows:
                d = row.asDict()
                fmt = d.get("format") or "warc"
                if fmt not in outs:
                    name = f"{tag}.{fmt}.gz"
                    outs[fmt] = fs.open_output_stream(f"{staging}/{name}", compression=None)
                    files.append(name)
                    if fmt == "arc":
                        outs[fmt].write(gzip_member(arc_file_header(name)))
                if fmt == "arc":
                    rec = arc_record(d.get("url"), d.get("date_raw"), mime_of_head(d.get("http_head")),
                                     d.get("http_head"), d.get("content"))
                else:
                    rec = warc_record(d.get("url"), d.get("date_raw"), d.get("record_type"),
                                      d.get("http_head"), d.get("content"))
                outs[fmt].write(gzip_member(rec))
        finally:
            for o in outs.values():
                o.close()
        return _Commit(files)

    def commit(self, messages):
        from pyarrow import fs as pafs
        fs, base = _fs_and_path(self.path)
        if self.overwrite:
            for i in fs.get_file_info(pafs.FileSelector(base)):
                if i.type == pafs.FileType.File and not i.base_name.startswith((".", "_")):
                    fs.delete_file(i.path)
        for m in messages:
            for name in (m.files if m is not None else []):
                fs.move(f"{base}/{STAGING}/{name}", f"{base}/{name}")
        fs.delete_dir(f"{base}/{STAGING}")

    def abort(self, messages):
        fs, base = _fs_and_path(self.path)
        try:
            fs.delete_dir(f"{base}/{STAGING}")
        except OSError:
            pass


class WebArchiveDataSource(DataSource):
    @classmethod
    def name(cls):
        return "webarchive"

    def schema(self):
        return RECORD_SCHEMA

    def reader(self, schema):
        return WebArchiveReader(self.options, schema)

    def writer(self, schema, overwrite):
        return WebArchiveWriter(self.options, overwrite)


def register(spark) -> None:
    """Make ``format("webarchive")`` available in this session. The module
    is shipped to the Python workers by value, so executors need no install
    of this package."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(WebArchiveDataSource)


def read_archive(spark, path: str | list[str], columns: list[str] | None = None, **options):
    """``spark.read.format("webarchive")`` with the source registered. With
    ``columns`` only these come back, and bodies are not read unless they are asked for
    (Python sources get no column pruning from Spark)."""
    register(spark)
    options.setdefault("minPartitions", spark.sparkContext.defaultParallelism)
    if columns is not None and "content" not in columns:
        options["withContent"] = "false"
    reader = spark.read.format("webarchive")
    for k, v in options.items():
        reader = reader.option(k, str(v))
    df = reader.load(path)
    return df.select(*columns) if columns is not None else df


def write_archive(records, path: str) -> str:
    """Write capture records (``RECORD_SCHEMA`` columns) as gzip archives."""
    register(records.sparkSession)
    cols = [c for c in ("format", "record_type", "url", "date_raw", "http_head", "content") if c in records.columns]
    records.select(*cols).write.format("webarchive").mode("overwrite").save(path)
    return path
