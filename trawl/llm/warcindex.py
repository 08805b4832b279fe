"""Operator 1, web archives with an external merge of their capture index.

Writing: every Spark task appends one gzip member per record to an archive of
its own in shared storage and returns a run of index rows sorted by (URL key, timestamp,
page). A later attempt writes another file, and only the rows of the attempt that
succeeded are kept, so a lost executor leaves at most files that no index names.

Merging: the runs are cut at common key ranges (a range exchange that keeps
each run's order, with the page as tie-breaker, so one URL may span ranges); a task merges the k run
slices of its range by a loser tree. Ranges are sized by row count, so a
task holds a bounded number of index rows. The merged index lists all captures in
global order, each URL's history together and by time.

Reading: records are fetched by the index, file and offset, and parsed.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import scratch, written
from trawl.sources import webarchive
from trawl.sources.webarchive import _fs_and_path, gzip_member

cloudpickle.register_pickle_by_value(webarchive)  # its helpers run in tasks

RUN_ROWS = 50_000  # index rows of a run, at most
MERGE_ROWS = 100_000  # index rows a merge task holds, about
INDEX = "urlkey string, ts string, page_id long, file string, offset long, length long, run long"
_INDEX_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
_INDEX_NAMES = ["urlkey", "ts", "page_id", "file", "offset", "length", "run"]


def url_key(url: Column) -> Column:
    """Sort-friendly URL: lower-case host labels reversed and comma-joined, then the rest. Null: empty."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    bare = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1))
    host = F.regexp_replace(host, r"^(www\d*\.)|(:(80|443)$)", "")
    rest = F.regexp_replace(F.regexp_extract(bare, r"^[^/?#]*([^#]*)", 1), "^$", "/")
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), rest)


# ---- records -----------------------------------------------------------------

def record(page, url, ts, payload: bytes, digest: str, refers) -> bytes:
    """One WARC 1.1 record, a revisit without its payload if ``refers`` is a page."""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
            f"WARC-Date: {ts[:4]}-{ts[4:6]}-{ts[6:8]}T{ts[8:10]}:{ts[10:12]}:{ts[12:14]}Z",
            f"WARC-Payload-Digest: sha1:{b32}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    else:
        body += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record; payload size and digest are taken from the payload itself where it is there."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    page = lambda name: (lambda v: int(v) if v else None)(fields.get(name, "")[10:-1])
    said = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    if fields["WARC-Type"] == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if digest != said:
            raise ValueError(f"payload of record {fields['WARC-Record-ID']} does not match its digest")
    else:
        size, digest = int(fields["X-Payload-Length"]), said
    return {"page_id": page("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"), "url": fields.get("WARC-Target-URI")}


# ---- writing -----------------------------------------------------------------

def captures(pages: DataFrame, *, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """page_id, url, urlkey, ts, payload, digest, refers (null: response)."""
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("urlkey", url_key(F.col("url")))
    stamp = F.timestamp_seconds(F.lit(1577836800) + F.coalesce(F.pmod("page_id", F.lit(4_000_000_000)), F.lit(0)))
    rows = rows.withColumn("ts", F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), "yyyyMMddHHmmss"))
    # one narrow row for each payload that occurs again
    again = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("_keeper"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and _keeper is not null").drop("_n"))
    j = rows.join(again, "digest", "left")
    refers = F.when(F.col("_keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keeper")), F.col("_keeper"))
    return j.select("page_id", "url", "urlkey", "ts", "payload", "digest", refers.alias("refers"))


def write_runs(caps: DataFrame, folder: str) -> DataFrame:
    """Archives in ``folder``; returns the index as sorted runs, each of at most ``RUN_ROWS`` rows of one task."""
    def run(batches):
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
        out, at, rows, runs = None, 0, [], 0
        try:
            for b in batches:
                if out is None and len(b):
                    fs, path = _fs_and_path(name)
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                for i in range(len(b)):
                    page, url, key, ts, payload, digest, refers = (b.column(c)[i].as_py() for c in range(7))
                    member = gzip_member(record(page, url, ts, payload, digest, refers))
                    out.write(member)
                    rows.append((key, ts, page, name, at, len(member), (part << 32) + runs))
                    at += len(member)
                    if len(rows) == RUN_ROWS:
                        yield batch_of(sorted(rows, key=order_key))
                        rows, runs = [], runs + 1
        finally:
            if out is not None:
                out.close()
        if rows:
            yield batch_of(sorted(rows, key=order_key))

    return written(caps.mapInArrow(run, INDEX), "warc-runs")


def batch_of(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _INDEX_TYPES, strict=True)], _INDEX_NAMES)


def order_key(row):
    """URL key, timestamp, page (null first), then the place, which is unique."""
    return (row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4])


# ---- merging -----------------------------------------------------------------

class LoserTree:
    """k-way merge of sorted lists: inner nodes hold the losers of their matches, so
    the next row costs one match per level."""

    def __init__(self, runs, key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.at = [0] * self.k
        self.heads = [self._head(i) for i in range(self.k)]
        self.tree = [None] * self.k  # tree[0] is the overall winner
        for i in range(self.k):
            self._enter(i)

    def _head(self, i):
        """(exhausted, key): an ended run loses to all others."""
        if i < len(self.runs) and self.at[i] < len(self.runs[i]):
            return (False, self.key(self.runs[i][self.at[i]]))
        return (True,)

    def _enter(self, i):
        """First matches: leaves wait at the first empty node on their way up."""
        node = (i + self.k) // 2
        while node > 0:
            if self.tree[node] is None:
                self.tree[node] = i
                return
            if self.heads[self.tree[node]] < self.heads[i]:
                self.tree[node], i = i, self.tree[node]
            node //= 2
        self.tree[0] = i

    def __iter__(self):
        while not self.heads[self.tree[0]][0]:
            i = self.tree[0]
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self._head(i)
            node = (i + self.k) // 2
            while node > 0:
                if self.heads[self.tree[node]] < self.heads[i]:
                    self.tree[node], i = i, self.tree[node]
                node //= 2
            self.tree[0] = i


def merge_runs(index: DataFrame) -> DataFrame:
    """``index`` in global order with its ``position`` (from 0)."""
    spark = index.sparkSession
    total = index.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // MERGE_ROWS))
    key = ["urlkey", "ts", F.col("page_id").asc_nulls_first(), "file", "offset"]
    # within a range the rows come run by run, each run in its own order
    ranged = index.repartitionByRange(parts, *key).sortWithinPartitions("run", *key)

    def run(batches):
        part, runs = TaskContext.get().partitionId(), {}
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                runs.setdefault(row[6], []).append(row)
        merged, i = iter(LoserTree(list(runs.values()), order_key)), 0
        while rows := list(islice(merged, RUN_ROWS)):
            some = batch_of(rows)
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array([part] * len(some), pa.int32()), pa.array(range(i, i + len(some)), pa.int64())],
                                             [*_INDEX_NAMES, "_part", "_pos"])
            i += len(some)

    merged = written(ranged.mapInArrow(run, INDEX + ", _part int, _pos long"), "warc-merged")
    # one row per range
    counts = sorted((r["_part"], r["count"]) for r in merged.groupBy("_part").count().collect())
    starts, before = [], 0
    for part, n in counts:
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, "_part int, _before long")
    return merged.join(F.broadcast(offsets), "_part").withColumn("position", F.col("_before") + F.col("_pos")).drop("_part", "_pos", "_before")


# ---- reading -----------------------------------------------------------------

def read_records(index: DataFrame) -> DataFrame:
    """The records an index names, with the index's urlkey, ts and position."""
    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = index.select("file", "offset", "length", "urlkey", "ts", "position").repartitionByRange(parts, "file", "offset") \
        .sortWithinPartitions("file", "offset")

    def run(batches):
        opened, f = None, None
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "urlkey", "ts", "position"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            rows = []
            for file, offset, length, key, ts, position in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if file != opened:
                    if f is not None:
                        f.close()
                    fs, path = _fs_and_path(file)
                    opened, f = file, fs.open_input_file(path)
                r = parse(zlib.decompress(f.read_at(length, offset), 31))
                rows.append((*r.values(), key, ts, position))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        if f is not None:
            f.close()

    return placed.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                                  "url string, urlkey string, ts string, position long")


def archive(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """Writes ``pages`` as archives, merges their index and reads all records back.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, url, urlkey, ts, position), one row per page row. Null
    html is the empty payload. Of equal payloads of at least ``min_bytes`` the
    row with the largest page_id is the response (repeated rows with that id all are;
    rows without id refer to it; if no row has an id, all are responses). Null urls sort
    first with the empty key. Other columns are not read; an empty table gives an empty result.
    """
    caps = captures(pages, id_col=id_col, url_col=url_col, html_col=html_col, min_bytes=min_bytes)
    return read_records(merge_runs(write_runs(caps, scratch(pages.sparkSession, "warc"))))
