"""

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
driver tables (or data Spark derives from them). Column names and types
match the DuckDB oracle in ``plans.oracle``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions import http
from trawl.functions.text import (date_mention, date_normalise, lastwins_attempts, lastwins_parts,
                                  lastwins_pattern, lastwins_value, normalise_mention, word_count)
from trawl.functions.urls import domain
from trawl.operators import article, entities, filters, joins, stats
from trawl.operators.dedup import cap_per_file
from trawl.operators.pubdate import pub_date
from trawl.operators.snapshot import to_snapshots, with_text
from trawl.plans import jobs
from trawl.session import Workspace, ensure_conf
from trawl.sources import fixtures as fx
from trawl.sources import sinks
from trawl.sources.webarchive import TASK_BYTES, read_archive, write_archive

Query = Callable[[SparkSession, str], DataFrame]
TS_MS = "yyyy-MM-dd HH:mm:ss.SSS"


def _pages(spark, sf_dir):
    ensure_conf(spark)
    return fx.table(spark, sf_dir, "pages")


def _snaps(spark, sf_dir):
    return to_snapshots(fx.capture_records(spark, sf_dir))


# ---- projections over pages -------------------------------------------------

def q_domain(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", "url", domain(F.col("url")).alias("domain"))


def q_title(spark, sf_dir):
    ensure_conf(spark)
    p = fx.reference_pages(spark, sf_dir)
    return p.select("page_id", H.title(F.col("html")).alias("title"))


def q_word_count(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", word_count(H.visible_text(F.col("html"))).alias("wc"))


def q_document_word_count(spark, sf_dir):
    """P14 over the long prose of ``documents`` (whole texts)."""
    ensure_conf(spark)
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", word_count(F.col("text")).alias("wc"))


def q_outlinks(spark, sf_dir):
    ensure_conf(spark)
    p = fx.linked_pages(spark, sf_dir)
    links = H.outlinks(F.col("html"))
    return p.select("page_id", F.array_join(links, " ").alias("links"), F.size(links).alias("n_links"))


def q_link_edges(spark, sf_dir):
    ensure_conf(spark)
    p = fx.linked_pages(spark, sf_dir).withColumn("links", H.outlinks(F.col("html")))
    return stats.link_edges(p)


def q_distinct_links(spark, sf_dir):
    return stats.distinct_links(q_link_edges(spark, sf_dir))


# ---- article extraction -----------------------------------------------------

def q_article_blocks(spark, sf_dir):
    b = article.blocks(_pages(spark, sf_dir), "page_id")
    return b.select("page_id", "pos", "words", "anchor_words", "keep")


def q_article_text(spark, sf_dir):
    ensure_conf(spark)
    p = article.with_article(fx.reference_pages(spark, sf_dir))
    return p.select("page_id", "article", "wc")


def _page_articles(spark, sf_dir):
    return article.with_article(_pages(spark, sf_dir)).select("page_id", "article")


def q_entity_mentions(spark, sf_dir):
    m = entities.entity_mentions(_page_articles(spark, sf_dir), fx.gazetteer(spark, sf_dir), key="page_id")
    return m.select("page_id", "pos", "spot", "title", "rho")


def q_entity_string(spark, sf_dir):
    docs = _page_articles(spark, sf_dir)
    e = entities.with_entities(docs, fx.gazetteer(spark, sf_dir), key="page_id")
    return e.select("page_id", "entities")


# ---- dates over orders ------------------------------------------------------

def q_capture_ts14(spark, sf_dir):
    ensure_conf(spark)
    o = fx.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", http.ts14(F.col("o_orderdate")).alias("ts14"))


def q_date_mention(spark, sf_dir):
    t = fx.dated_text(spark, sf_dir)
    return t.select("o_orderkey", date_mention(F.col("text")).alias("mention"))


def q_date_normalize(spark, sf_dir):
    t = fx.dated_text(spark, sf_dir).withColumn("mention", date_mention(F.col("text")))
    return t.select("o_orderkey", "mention", normalise_mention(F.col("mention")).alias("normalized"))


def q_date_normalize_long(spark, sf_dir):
    """Every pattern of the list, written from the order dates."""
    t = fx.long_dated_text(spark, sf_dir)
    return t.select("o_orderkey", date_normalise(F.col("text")).alias("normalized"))


def q_date_lastwins(spark, sf_dir):
    t = fx.lastwins_text(spark, sf_dir).withColumn("_parts", lastwins_parts(F.col("text")))
    t = t.withColumn("_tries", lastwins_attempts(F.col("_parts")))
    return t.select("o_orderkey", "text",
                    F.date_format(lastwins_value(F.col("_tries")), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                    lastwins_pattern(F.col("_tries")).alias("pattern"))


def q_pub_date(spark, sf_dir):
    p = fx.dated_pages(spark, sf_dir).withColumn("domain", domain(F.col("url")))
    p = joins.with_hints(p, fx.domain_hints(spark, sf_dir))
    p = article.with_article(p)
    return p.select("page_id", "domain", "hint",
                    pub_date(F.col("html"), F.col("article"), F.col("hint")).alias("pub_date"))


# ---- snapshot columns -------------------------------------------------------

def q_mime_type(spark, sf_dir):
    s = _snaps(spark, sf_dir)
    return s.select("page_id", "content_type", "mime")


def q_mime_top_level(spark, sf_dir):
    s = _snaps(spark, sf_dir)
    return s.select("page_id", "mime", http.mime_top_level(F.col("mime")).alias("mime_top"))


def q_http_headers(spark, sf_dir):
    r = fx.capture_records(spark, sf_dir)
    h = http.headers(F.col("http_head"))
    lines = F.transform(F.array_sort(F.map_entries(h)), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return r.select("page_id", http.status(F.col("http_head")).alias("status"),
                    F.element_at(h, F.lit("content-type")).alias("content_type"),
                    F.size(F.map_keys(h)).alias("n_headers"),
                    F.array_join(lines, "\n").alias("headers"))


def q_capture_time(spark, sf_dir):
    s = _snaps(spark, sf_dir)
    return s.select("page_id", "format", "date_raw", F.date_format("ts", TS_MS).alias("ts"),
                    http.invalid_date(F.col("date_raw"), F.col("ts")).alias("invalid_date"))


def q_charset_decode(spark, sf_dir):
    s = with_text(_snaps(spark, sf_dir))
    page_text = F.decode(F.col("content"), "UTF-8")  # the fixture's body is the page as UTF-8
    told = s.select("page_id", F.lit(None).cast("string").alias("made"), "charset", F.length("html").alias("n_chars"),
                    (F.col("html") == page_text).alias("same_text"))
    old = with_text(fx.legacy_pages(spark, sf_dir))
    return told.unionByName(old.select("page_id", "made", "charset", F.length("html").alias("n_chars"), (F.col("html") == F.col("text")).alias("same_text")))


def q_content_cap(spark, sf_dir):
    s = fx.capture_records(spark, sf_dir)
    capped = http.cap_content(F.col("content"), CONTENT_CAP_QUERY_BYTES)
    return s.select("page_id", F.length(capped).alias("n_bytes"), F.hex(capped).alias("head_hex"))


# The cap is an option, off by default; this query shows it, at 2 KiB, where it
# cuts most pages (and some UTF-8 characters).
CONTENT_CAP_QUERY_BYTES = 2048


# ---- filters, audit, statistics ---------------------------------------------

SCAN_OPTIONS = dict(url_pattern="https://.*", mime_pattern="text/html|application/xhtml\\+xml",
                    status_selection=filters.STATUS_SUCCESS)
AUDIT_OPTIONS = dict(mime_pattern="text/html")


def q_scan_filters(spark, sf_dir):
    s = filters.apply_scan_filters(_snaps(spark, sf_dir), **SCAN_OPTIONS)
    return s.select("page_id", "url", "mime", "status")


def q_scan_audit(spark, sf_dir):
    return stats.scan_audit(_snaps(spark, sf_dir), **AUDIT_OPTIONS)


def q_quarantine(spark, sf_dir):
    """F7 on an archive with damaged members: the reader's errors and the records
    without an HTTP status line, with the reason."""
    ensure_conf(spark)
    path = fx.odd_archive(spark, sf_dir, _scratch(spark, "odd", sf_dir), "corrupt")
    _, bad = filters.split_quarantine(to_snapshots(read_archive(spark, path)))
    return bad.select("url", F.substring_index("quarantine_reason", ":", 1).alias("quarantine_reason"))


def q_status_counts(spark, sf_dir):
    return stats.status_counts(filters.apply_scan_filters(_snaps(spark, sf_dir)))


def q_mime_counts(spark, sf_dir):
    return stats.mime_counts(filters.only_ok(filters.apply_scan_filters(_snaps(spark, sf_dir))))


def q_run_stats(spark, sf_dir):
    ok = jobs.ok_captures(fx.capture_records(spark, sf_dir))
    return stats.run_stats(article.with_article(with_text(ok)))


# ---- joins, caps, jobs --------------------------------------------------------

def q_domain_allowlist(spark, sf_dir):
    ok = jobs.ok_captures(fx.capture_records(spark, sf_dir))
    return joins.allow_list(ok, fx.domains(spark, sf_dir)).select("page_id", "url", "domain")


def q_domain_list_scan(spark, sf_dir):
    """S3: the allow-list written twice, as line files in two nested
    folders, and read back recursively: distinct lines, verbatim."""
    from trawl.sources.lists import read_domain_list
    path = _scratch(spark, "lists", sf_dir)
    d = fx.domains(spark, sf_dir)
    d.write.mode("overwrite").text(f"{path}/a")
    d.write.mode("overwrite").text(f"{path}/b/nested")
    return read_domain_list(spark, path)


def q_cap_per_file(spark, sf_dir):
    ok = jobs.ok_captures(fx.capture_records(spark, sf_dir))
    kept = joins.allow_list(ok, fx.domains(spark, sf_dir))
    return cap_per_file(kept, 10).select("file", "rec_offset", "url")


def q_doc_project(spark, sf_dir):
    return jobs.documents(fx.capture_records(spark, sf_dir), fx.gazetteer(spark, sf_dir))


def q_text_rows(spark, sf_dir):
    rows = jobs.text_rows(fx.capture_records(spark, sf_dir), fx.domains(spark, sf_dir))
    return rows.select("file", "rec_offset", "value")


# ---- archive source and sinks (written under the shared folder, read back) ----

def _scratch(spark, kind: str, sf_dir: str) -> str:
    """A new folder, deleted when the application ends."""
    return Workspace(spark).folder(f"{kind}-{os.path.basename(sf_dir.rstrip('/'))}")


def _fixture_archive(spark, sf_dir) -> str:
    """Write the capture fixture as .warc.gz / .arc.gz; return the folder."""
    path = _scratch(spark, "archives", sf_dir)
    write_archive(fx.capture_records(spark, sf_dir), path)
    return path


def _archive_rows(scan: DataFrame) -> DataFrame:
    """Scan rows minus the file header the writer puts first in every ARC file."""
    writer_header = ((F.col("format") == "arc") & (F.col("rec_offset") == 0)
                     & F.col("url").startswith("filedesc://"))
    snaps = to_snapshots(scan.where(~writer_header))
    return snaps.select("url", "format", "record_type", "date_raw", "status",
                        F.md5(F.col("content")).alias("content_md5"), "error")


def q_warc_roundtrip(spark, sf_dir):
    return _archive_rows(read_archive(spark, _fixture_archive(spark, sf_dir)))


# Split size that cuts every test archive into dozens of ranges.
SMALL_SPLIT_BYTES = 4096


def q_warc_split_exact(spark, sf_dir):
    scan = read_archive(spark, _fixture_archive(spark, sf_dir),
                        maxPartitionBytes=SMALL_SPLIT_BYTES, openCostInBytes=0)
    return _archive_rows(scan)


def _odd_rows(spark, sf_dir, kind: str) -> DataFrame:
    """The rows of an archive of another make, read in one range a file and in many,
    whole bodies and capped at 1 MiB: ``setting`` says which."""
    ensure_conf(spark)
    path = fx.odd_archive(spark, sf_dir, _scratch(spark, "odd", sf_dir), kind)
    out = None
    for ranges, split in (("one", 1 << 40), ("many", SMALL_SPLIT_BYTES)):
        for cap in (None, 1 << 20):
            opts = {"maxPartitionBytes": split, "openCostInBytes": 0} | ({"maxContentBytes": cap} if cap else {}) \
                | ({"minPartitions": 1, "taskBytes": TASK_BYTES} if ranges == "one" else {})
            rows = read_archive(spark, path, **opts).select(
                F.lit(f"{ranges} {'capped' if cap else 'whole'}").alias("setting"), "url", "date_raw",
                F.md5("content").alias("content_md5"), F.substring_index("error", ":", 1).alias("error"))
            out = rows if out is None else out.unionByName(rows)
    return out


def q_warc_whole_gzip(spark, sf_dir):
    return _odd_rows(spark, sf_dir, "whole")


def q_warc_corrupt(spark, sf_dir):
    return _odd_rows(spark, sf_dir, "corrupt")


def q_arc_split_exact(spark, sf_dir):
    return _odd_rows(spark, sf_dir, "arc")


def _doc_rows(records: DataFrame) -> DataFrame:
    docs = jobs.extracted(jobs.ok_captures(records))
    return docs.select("id", "url", "file", "rec_offset", "rec_index", "wc")


def q_doc_upsert(spark, sf_dir):
    """Write the documents by bucket of their id, then upsert a recrawl batch: later copies
    (rec_offset + 100000) of the pages whose URL has a query; read back."""
    recs = fx.capture_records(spark, sf_dir)
    table = sinks.upsert_buckets(spark, _doc_rows(recs), _scratch(spark, "docs", sf_dir), buckets=16)
    copies = (recs.where(F.col("url").contains(fx.RECRAWL_MARK))
              .withColumn("rec_offset", F.col("rec_offset") + fx.COPY_OFFSET))
    sinks.upsert_buckets(spark, _doc_rows(copies), table)
    return sinks.read_buckets(spark, table).drop("rec_index")


def q_pub_date_list(spark, sf_dir):
    """P21 with the hint list as an input (J2): written as line files and read back."""
    from trawl.sources.lists import read_domain_hints
    path = _scratch(spark, "hints", sf_dir)
    h = fx.domain_hints(spark, sf_dir)
    h.select(F.concat("domain", F.lit("\t"), "hint")).write.text(path)
    p = fx.dated_pages(spark, sf_dir).withColumn("domain", domain(F.col("url")))
    p = article.with_article(joins.with_hints(p, read_domain_hints(spark, path)))
    return p.select("page_id", "domain", "hint",
                    pub_date(F.col("html"), F.col("article"), F.col("hint")).alias("pub_date"))


def q_json_lines(spark, sf_dir):
    """{url, ts, c, type, s} per status-200 capture, written and re-read."""
    ok = with_text(jobs.ok_captures(fx.capture_records(spark, sf_dir)))
    path = sinks.write_json_lines(ok.select(sinks.json_record().alias("r")).select("r.*"),
                                  _scratch(spark, "json", sf_dir), compression="gzip")
    back = spark.read.schema("url string, ts string, c string, type string, s int").json(path)
    return back.select("url", "ts", "type", "s", F.length("c").alias("c_chars"))


def q_text_export(spark, sf_dir):
    """S4 + X1: the text job written as gzip text over 4 files, re-read line
    by line (a newline inside a value starts a new line, as in the reference)."""
    rows = jobs.text_rows(fx.capture_records(spark, sf_dir), fx.domains(spark, sf_dir))
    path = sinks.write_text(rows, _scratch(spark, "text", sf_dir), files=4)
    return spark.read.text(path)


QUERIES: dict[str, Query] = {
    "domain": q_domain,
    "title": q_title,
    "word_count": q_word_count,
    "document_word_count": q_document_word_count,
    "outlinks": q_outlinks,
    "link_edges": q_link_edges,
    "distinct_links": q_distinct_links,
    "article_blocks": q_article_blocks,
    "article_text": q_article_text,
    "entity_mentions": q_entity_mentions,
    "entity_string": q_entity_string,
    "capture_ts14": q_capture_ts14,
    "date_mention": q_date_mention,
    "date_normalize": q_date_normalize,
    "date_normalize_long": q_date_normalize_long,
    "date_lastwins": q_date_lastwins,
    "pub_date": q_pub_date,
    "pub_date_list": q_pub_date_list,
    "mime_type": q_mime_type,
    "mime_top_level": q_mime_top_level,
    "http_headers": q_http_headers,
    "capture_time": q_capture_time,
    "charset_decode": q_charset_decode,
    "content_cap": q_content_cap,
    "scan_filters": q_scan_filters,
    "scan_audit": q_scan_audit,
    "quarantine": q_quarantine,
    "status_counts": q_status_counts,
    "mime_counts": q_mime_counts,
    "run_stats": q_run_stats,
    "domain_allowlist": q_domain_allowlist,
    "domain_list_scan": q_domain_list_scan,
    "cap_per_file": q_cap_per_file,
    "doc_project": q_doc_project,
    "text_rows": q_text_rows,
    "warc_roundtrip": q_warc_roundtrip,
    "warc_split_exact": q_warc_split_exact,
    "warc_whole_gzip": q_warc_whole_gzip,
    "warc_corrupt": q_warc_corrupt,
    "arc_split_exact": q_arc_split_exact,
    "doc_upsert": q_doc_upsert,
    "json_lines": q_json_lines,
    "text_export": q_text_export,
}
