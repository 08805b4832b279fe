"""Run statistics (A1-A5).

All counts are hash aggregates with map-side partial aggregation, so a
reason, MIME type or status that covers most rows still shuffles only one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions import http
from trawl.operators import filters


def audit_counts(**options) -> dict:
    """A1 as aggregate columns by name, for one pass with any other work: a
    count for every drop reason, and ``InvalidDate``, which drops no row."""
    reason = filters.scan_reason(**options)
    counts = {r: F.count_if(reason == r) for r in filters.REASONS}
    counts[filters.INVALID_DATE] = F.count_if((reason == filters.MATCHED) & http.invalid_date(F.col("date_raw"), F.col("ts")))
    return counts


def scan_audit(snaps: DataFrame, **options) -> DataFrame:
    """A1: records per drop reason (``Matched`` for kept ones; reasons that occur), plus the
    ``InvalidDate`` count. One aggregate over one scan, turned into rows."""
    counts = audit_counts(**options)
    one = snaps.agg(*[c.alias(k) for k, c in counts.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("reason"), F.col(k).alias("n")) for k in counts])
    return one.select(F.inline(rows)).where((F.col("n") > 0) | (F.col("reason") == filters.INVALID_DATE))


def run_stats(docs: DataFrame) -> DataFrame:
    """A2: ``Matched`` = rows that reached extraction; ``Failed`` = those
    whose extraction produced no row. Counted in one pass."""
    return docs.agg(
        F.count(F.lit(1)).alias("matched"),
        F.count_if(F.col("wc").isNull() | (F.col("wc") == 0)).alias("failed"),
    )


def mime_counts(snaps: DataFrame) -> DataFrame:
    """A3: rows per MIME top-level type."""
    return (snaps.select(http.mime_top_level(F.col("mime")).alias("mime_top"))
            .groupBy("mime_top").agg(F.count(F.lit(1)).alias("n")))


def status_counts(snaps: DataFrame) -> DataFrame:
    """A4: rows per HTTP status, before the 200 filter."""
    return snaps.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def link_edges(pages: DataFrame, links_col: str = "links", src: str = "url") -> DataFrame:
    """One row per (page, outlink). The outer explode keeps Spark from inferring a filter on the array's
    size, which would compute the links a second time."""
    return pages.select(F.col(src).alias("src"), F.explode_outer(links_col).alias("link")).where(F.col("link").isNotNull())


def distinct_links(edges: DataFrame) -> DataFrame:
    """A5: every distinct link of the corpus and how many distinct pages
    point to it. The (link, src) pairs are de-duplicated first, hashed on
    both columns, so a link present on most pages is not one task's work;
    the per-link count is then a partial + final aggregate."""
    pairs = edges.select("link", "src").distinct()
    return pairs.groupBy("link").agg(F.count(F.lit(1)).cast("long").alias("in_degree"))
