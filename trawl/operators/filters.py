"""Scan filters, the drop reason, and the quarantine split.

The reference applies its filters inside the record reader in a fixed
cheap-first order and counts the first check that fails. ``scan_reason``
is that order as one ``CASE`` column, so keeping rows and counting why the
rest went are one projection over the same scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Counter names of the reference's reader, kept verbatim.
SKIPPED = "Skipped"                      # unparseable record
SKIPPED_WARC_TYPE = "SkippedWarcType"    # irrelevant record type / ARC file header
SKIPPED_MIME_TYPE = "SkippedMimeType"
SKIPPED_HTTP_STATUS = "SkippedHttpStatus"
SKIPPED_URL = "SkippedUrl"
MATCHED = "Matched"
INVALID_DATE = "InvalidDate"
REASONS = [MATCHED, SKIPPED, SKIPPED_WARC_TYPE, SKIPPED_MIME_TYPE, SKIPPED_HTTP_STATUS, SKIPPED_URL]

STATUS_ALL = "ALL"
STATUS_SUCCESS = "SUCCESS"


def _anchored(pattern: str) -> str:
    return f"^(?:{pattern})$"


def is_header_record() -> Column:
    """ARC file header (no URL or ``filedesc://``), or a WARC record
    whose type is present and not ``response``."""
    fmt, url, rtype = F.col("format"), F.col("url"), F.col("record_type")
    arc_header = (fmt == "arc") & (url.isNull() | url.startswith("filedesc://"))
    other_type = rtype.isNotNull() & (rtype != "response")
    return F.coalesce(arc_header, F.lit(False)) | F.coalesce(other_type, F.lit(False))


def scan_reason(url_pattern: str | None = None, mime_pattern: str | None = None,
                status_selection: str = STATUS_ALL) -> Column:
    """A1: the first failing check in the order type -> URL -> parse ->
    MIME -> status; ``Matched`` when all pass. Needs snapshot columns."""
    reason = F.when(is_header_record(), F.lit(SKIPPED_WARC_TYPE))
    if url_pattern is not None:
        reason = reason.when(~F.coalesce(F.col("url").rlike(_anchored(url_pattern)), F.lit(False)),
                             F.lit(SKIPPED_URL))
    reason = reason.when(F.col("status").isNull(), F.lit(SKIPPED))
    if mime_pattern is not None and mime_pattern != ".*":
        reason = reason.when(~F.col("mime").rlike(_anchored(mime_pattern)), F.lit(SKIPPED_MIME_TYPE))
    if status_selection == STATUS_SUCCESS:
        reason = reason.when(F.col("status") >= 300, F.lit(SKIPPED_HTTP_STATUS))
    return reason.otherwise(F.lit(MATCHED))


def with_reason(snaps: DataFrame, **options) -> DataFrame:
    return snaps.withColumn("reason", scan_reason(**options))


def apply_scan_filters(snaps: DataFrame, **options) -> DataFrame:
    """Keep what the reference's reader hands to the mapper."""
    return snaps.where(scan_reason(**options) == MATCHED)


def only_ok(snaps: DataFrame) -> DataFrame:
    """HTTP status exactly 200."""
    return snaps.where(F.col("status") == 200)


def non_empty_article(docs: DataFrame, wc: str = "wc") -> DataFrame:
    """drop documents whose article has no words."""
    return docs.where(F.col(wc) > 0)


def error_reason() -> Column:
    """why a record is quarantined; NULL for a good record. A reader
    error (``error`` column) wins over a parse failure of the HTTP head."""
    return F.coalesce(
        F.col("error"),
        F.when(~is_header_record() & F.col("status").isNull(), F.lit("no HTTP status line")),
    )


def split_quarantine(snaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) from one snapshot frame. Quarantined rows keep
    their key and the reason instead of being dropped unseen."""
    if "error" not in snaps.columns:
        snaps = snaps.withColumn("error", F.lit(None).cast("string"))
    flagged = snaps.withColumn("quarantine_reason", error_reason())
    good = flagged.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason")
    bad = flagged.where(F.col("quarantine_reason").isNotNull())
    return good, bad
