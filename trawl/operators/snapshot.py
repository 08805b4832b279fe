"""Capture record -> snapshot.

Adds the parsed HTTP columns to each record with built-in expressions
only; the DataFrame stays one narrow projection over the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions import http


def to_snapshots(records: DataFrame) -> DataFrame:
    """Adds ``status``, ``content_type``, ``mime`` and ``ts``."""
    head = F.col("http_head")
    ct = http.header(head, "content-type")
    return (records
            .withColumn("status", http.status(head))
            .withColumn("content_type", ct)
            .withColumn("mime", http.mime(F.col("content_type")))
            .withColumn("ts", http.capture_time(F.col("format"), F.col("date_raw"))))


def with_ts14(df: DataFrame) -> DataFrame:
    """P7 + P8: 14-digit capture time and the document id ``ts14 || url``; without
    a capture time the id is the URL alone."""
    return (df.withColumn("ts14", http.ts14(F.col("ts")))
              .withColumn("id", F.concat(F.coalesce(F.col("ts14"), F.lit("")), F.col("url"))))


def with_text(df: DataFrame, cap_bytes: int | None = None) -> DataFrame:
    """P10 + P11: the body, or its first ``cap_bytes`` bytes, decoded to ``html``
    by its resolved charset."""
    body, cut = F.col("content"), None
    if cap_bytes is not None:
        cut = F.length(body) > cap_bytes
        # a reader that cut the body itself returns exactly the cap
        cut = cut | (F.length(body) == cap_bytes)
        body = http.cap_content(body, cap_bytes)
    return (df.withColumn("charset", http.resolve_charset(F.col("content_type"), body, cut))
              .withColumn("html", http.decode_content(body, F.col("charset"))))
