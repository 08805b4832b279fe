"""

``documents`` is the index job, ``text_rows`` the text job. Both start
from capture records: a real scan (``sources.webarchive``) or a fixture
(``sources.fixtures``), which have the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trawl.functions.urls import domain
from trawl.operators import article, entities, filters, joins, stats
from trawl.operators.dedup import cap_per_file, keep_latest
from trawl.operators.pubdate import pub_date
from trawl.operators.snapshot import to_snapshots, with_text, with_ts14
from trawl.session import Workspace
from trawl.sources.fetch import PLACE, fetch_records
from trawl.sources.webarchive import FIELDS, read_archive

DOC_COLUMNS = ["ts", "url", "id", "domain", "wc", "html", "entities"]


#: Names of the quarantine's count in a job's observation, and of the reader's errors among them.
QUARANTINED, CORRUPT = "Quarantined", "Corrupt"


def failed_share(counts: dict) -> float:
    """the share of records that the reader could not read, from a job's observed counts."""
    return counts[CORRUPT] / max(1, sum(counts[r] for r in filters.REASONS))


def observed(snaps: DataFrame, observation: Observation | None, **scan_options) -> DataFrame:
    """Counts A1 and the quarantined records while ``snaps`` is scanned for the job."""
    if observation is None:
        return snaps
    counts = stats.audit_counts(**scan_options)
    counts[QUARANTINED] = F.count_if(filters.error_reason().isNotNull())
    counts[CORRUPT] = F.count_if(F.col("error").isNotNull())
    return snaps.observe(observation, *[c.alias(k) for k, c in counts.items()])


def ok_captures(records: DataFrame, observation: Observation | None = None, **scan_options) -> DataFrame:
    """Stages 4 and the first map step: snapshot columns, scan filters
    (F1-F4), status 200 (F5), domain (P9; NULL -> dropped, D2), id (P7/P8).
    A missing capture time leaves ``ts`` NULL and the id is the URL alone."""
    snaps = observed(to_snapshots(records), observation, **scan_options)
    snaps = filters.apply_scan_filters(snaps, **scan_options)
    ok = filters.only_ok(snaps).withColumn("domain", domain(F.col("url"))).where(F.col("domain").isNotNull())
    return with_ts14(ok)


def extracted(captures: DataFrame, cap_bytes: int | None = None) -> DataFrame:
    """P10/P11 decode, P13 article, P14 word count, F6 non-empty."""
    return filters.non_empty_article(article.with_article(with_text(captures, cap_bytes)))


def latest_documents(records: DataFrame, cap_bytes: int | None = None, **scan_options) -> DataFrame:
    """Captures extracted in the scan stage, the latest of each id (A7). Only what a document
    needs crosses the one shuffle, not the raw body; a partial WindowGroupLimit before
    it lets copies of a hot id collapse map-side."""
    docs = extracted(ok_captures(records, **scan_options), cap_bytes)
    docs = docs.select("ts14", "url", "id", "domain", "wc", "html", "article", "file", "rec_offset", "rec_index")
    return keep_latest(docs, "id").drop("file", "rec_offset", "rec_index")


def documents(records: DataFrame, gazetteer: DataFrame, cap_bytes: int | None = None,
              hints: DataFrame | None = None, ws: Workspace | None = None, **scan_options) -> DataFrame:
    """Index job: one document per id (the latest capture wins, A7), with
    its entity string (P16/P17) -> P23 columns; with ``hints`` (domain, hint) also the
    publication date (P21).

    The documents are written once to ``ws``, in buckets of their id: extraction is the costly part, annotation
    reads the articles and the result the whole rows, and neither may run it again. The buckets are those of
    the keep-latest's shuffle, so html moves in that one exchange: the entity strings and the hints come
    to the documents, by id. Close ``ws`` (or let the application end) once the result is used."""
    own = ws or Workspace(records.sparkSession)
    rows = annotated(own.bucketed(latest_documents(records, cap_bytes, **scan_options), "id", "documents"), gazetteer, hints, own)
    if ws is None:
        own.unlist()
    return rows


def annotated(docs: DataFrame, gazetteer: DataFrame, hints: DataFrame | None, ws: Workspace) -> DataFrame:
    """The index job's result from its documents, bucketed by id: what is added comes to them."""
    out = [F.col("ts14").alias("ts"), "url", "id", "domain", "wc", "html", "entities"]
    side = entities.entity_strings(docs.select("id", "article"), gazetteer, key="id", text_col="article", ws=ws)
    rows = docs.join(side, on="id", how="left").withColumn("entities", F.coalesce("entities", F.lit("")))
    if hints is not None:
        known = joins.with_hints(docs.select("id", "domain"), hints).where("hint is not null").select("id", "hint")
        rows = rows.join(known, on="id", how="left")
        out.append(pub_date(F.col("html"), F.col("article"), F.col("hint")).alias("pub_date"))
    return rows.select(*out)


DOCUMENT = ["ts14", "url", "id", "domain", "wc", "html", "article"]


def archive_documents(spark: SparkSession, path: str | list[str], gazetteer: DataFrame, cap_bytes: int | None = None,
                      hints: DataFrame | None = None, ws: Workspace | None = None, observation: Observation | None = None,
                      reader: dict | None = None, **scan_options) -> DataFrame:
    """The index job over archives with late extraction: the rows of ``documents``, for crawls that capture much of it again.

    A first read without bodies ranks the captures of an id as narrow rows (A7). Then only the latest ones'
    bodies are read, by file and offset, and decoded; copies that lose are neither decoded nor shuffled. The few ids whose
    latest capture has no article (F6) get a second turn, over their other captures. The documents move once, to the buckets of their id."""
    given, ws = ws, ws or Workspace(spark)
    reader = {"responsesOnly": "true", **(reader or {})}
    bare = read_archive(spark, path, columns=[c for c in FIELDS if c != "content"], **reader, **({"keepFiltered": "true"} if observation else {}))
    keys = ws.written(ok_captures(bare, observation, **scan_options).select("id", *PLACE), "captures")
    latest = ws.written(keep_latest(keys, "id"), "latest")

    def read(places: DataFrame) -> DataFrame:
        return article.with_article(with_text(ok_captures(fetch_records(places, cap_bytes), **scan_options), cap_bytes))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = ws.bucketed(read(latest).select(*DOCUMENT).repartition(parts, "id"), "id", "documents")
    empty = ws.written(first.where("wc = 0").select("id"), "empty")
    docs = filters.non_empty_article(first)
    if not empty.isEmpty():
        others = keys.join(empty, "id", "left_semi").join(latest.select(*PLACE), PLACE, "left_anti")
        again = filters.non_empty_article(read(others))
        again = keep_latest(again.select(*DOCUMENT, *PLACE), "id").select(*DOCUMENT)
        docs = filters.non_empty_article(ws.append(again, "id"))
    rows = annotated(docs, gazetteer, hints, ws)
    if given is None:
        ws.unlist()
    return rows


def text_rows(records: DataFrame, domains: DataFrame, per_file: int | None = None,
              cap_bytes: int | None = None, **scan_options) -> DataFrame:
    """Text job: allow-listed domains (J1), article text -> ``value = ts14 ||
    '\\n' || article`` (P22). With ``per_file`` at most so many captures per
    source file (L1, counted before F6 as in the reference)."""
    kept = joins.allow_list(ok_captures(records, **scan_options), domains)
    if per_file is not None:
        kept = cap_per_file(kept, per_file)
    rows = extracted(kept, cap_bytes)
    return rows.select("file", "rec_offset", "rec_index",
                       F.concat(F.coalesce(F.col("ts14"), F.lit("")), F.lit("\n"), F.col("article")).alias("value"))
