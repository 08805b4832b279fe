"""Records read by their place (late extraction): the second read of a job that has decided on narrow rows
which captures it wants.

The places are dealt in ranges of file and offset, so a task reads its files forward, opens each once
and inflates each wanted gzip member once; what is not asked for is not read.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame

from trawl.sources import webarchive as W

PLACE = ["file", "rec_offset", "rec_index"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no install of the package


def _records_at(r, path: str, gz: bool, fmt: str, offset: int, cap: int | None):
    """The records that begin at an offset: those of a gzip member, or the one of a plain file."""
    if gz:
        yield from W._records(W._Member(r, offset), path, offset, fmt, cap)
        return
    s = W._Plain(r, offset)
    yield {**W._record(s, fmt, cap), "file": path, "rec_offset": offset, "rec_index": 0}


def _wanted(path: str, places: list[tuple[int, int]], cap: int | None):
    """The records of one file at (offset, index), in order; an error row where there is none any more."""
    fmt, gz = W.archive_format(path.removesuffix(".gz")), path.lower().endswith(".gz")
    fs, p = W._fs_and_path(path)
    with fs.open_input_file(p) as f:
        r = W._Reader(f, f.size())
        at = 0
        while at < len(places):
            offset, end = places[at][0], at
            while end < len(places) and places[end][0] == offset:
                end += 1
            asked, last = {i for _, i in places[at:end]}, places[end - 1][1]
            found = set()
            try:
                for rec in _records_at(r, path, gz, fmt, offset, cap):
                    if rec["rec_index"] in asked:
                        found.add(rec["rec_index"])
                        yield rec
                    if rec["rec_index"] >= last:
                        break
            except W._Unparseable:
                pass
            for i in sorted(asked - found):
                yield W._error_row(path, offset, i, fmt, "no record at this place")
            at = end


def fetch_records(places: DataFrame, cap: int | None = None) -> DataFrame:
    """The records (``RECORD_SCHEMA``, with bodies) at the distinct places (file, rec_offset, rec_index) of an earlier scan.
    A place that holds no record any more gives an error row; a file that is gone fails the job."""
    W.register(places.sparkSession)

    def run(batches):
        import pyarrow as pa
        cols, size = {k: [] for k in W.FIELDS}, 0

        def held():  # one file's places at a time; those of a task are in order
            path, some = None, []
            for b in batches:
                for f, o, i in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if some and f != path:
                        yield path, some
                        some = []
                    path = f
                    some.append((o, i))
            if some:
                yield path, some

        for path, some in held():
            for rec in _wanted(path, some, cap):
                for k in W.FIELDS:
                    cols[k].append(rec[k])
                size += len(rec["content"] or b"")
                if len(cols["file"]) >= W.BATCH_ROWS or size >= W.BATCH_BYTES:
                    yield W._batch(pa, cols)
                    cols, size = {k: [] for k in W.FIELDS}, 0
        if cols["file"]:
            yield W._batch(pa, cols)

    one = places.select(*PLACE).where("file is not null").repartitionByRange("file", "rec_offset").sortWithinPartitions(*PLACE)
    return one.mapInArrow(run, W.RECORD_SCHEMA)
