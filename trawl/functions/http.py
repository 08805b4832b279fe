"""HTTP capture columns derived from the raw response head.

Every function takes and returns Columns; nothing here leaves the JVM.
The archive source hands over ``http_head`` (status line + header lines,
decoded as ISO-8859-1) and ``content`` (the body bytes); the rest of the
snapshot is computed from those two columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.charsets import legacy_charset

# Fixed values.
# Content cap that both reference jobs apply before decoding: 1 MiB. Ours is an option.
CONTENT_CAP_BYTES = 1024 * 1024
# MIME placeholder when the response has no Content-Type (our definition).
NO_TYPE = "no-type"
# MIME top-level for a value that does not parse as type/subtype.
UNKNOWN_TYPE = "unknown"
# Charsets the decoder is allowed to use; any other declared name falls
# back to UTF-8 so one odd header cannot fail a task (H3).
KNOWN_CHARSETS = [
    "UTF-8", "UTF-16", "UTF-16LE", "UTF-16BE", "UTF-32", "US-ASCII",
    "ISO-8859-1", "ISO-8859-2", "ISO-8859-5", "ISO-8859-7", "ISO-8859-9",
    "ISO-8859-15", "WINDOWS-1250", "WINDOWS-1251", "WINDOWS-1252",
    "WINDOWS-1253", "WINDOWS-1254", "WINDOWS-1256", "KOI8-R", "KOI8-U",
    "SHIFT_JIS", "EUC-JP", "ISO-2022-JP", "EUC-KR", "GBK", "GB2312",
    "GB18030", "BIG5",
]
# Common aliases, mapped to the names above.
CHARSET_ALIASES = {
    "UTF8": "UTF-8", "LATIN1": "ISO-8859-1", "LATIN-1": "ISO-8859-1",
    "ASCII": "US-ASCII", "CP1252": "WINDOWS-1252", "CP1251": "WINDOWS-1251",
    "CP1250": "WINDOWS-1250", "X-SJIS": "SHIFT_JIS", "SJIS": "SHIFT_JIS",
}

# RFC 2045 token characters, used to validate type/subtype (P5).
_TOKEN = r"[!#$%&'*+.^_`|~0-9A-Za-z-]+"


def status(head: Column) -> Column:
    """Three-digit status code from the status line; NULL if absent."""
    code = F.regexp_extract(head, r"^HTTP/[^ \t]+[ \t]+([0-9]{3})", 1)
    return F.when(code != "", code.cast("int"))


def _tail(lines: Column) -> Column:
    return F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))


def _after_colon(line: Column) -> Column:
    return F.substring(line, F.instr(line, ":") + 1, 1 << 30)


def header_lines(head: Column) -> Column:
    """Header lines after the status line that carry a ``name:``."""
    return F.filter(_tail(F.split(head, "\r?\n")), lambda l: F.instr(l, ":") > 0)


def headers(head: Column) -> Column:
    """Header map, keys lower-cased and trimmed, last duplicate wins.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (set by ensure_conf).
    """
    entries = F.transform(
        header_lines(head),
        lambda l: F.struct(
            F.lower(F.trim(F.substring_index(l, ":", 1))).alias("key"),
            F.trim(_after_colon(l)).alias("value"),
        ),
    )
    return F.map_from_entries(entries)


def header(head: Column, name: str) -> Column:
    """Case-insensitive single header value."""
    return F.element_at(headers(head), F.lit(name.lower()))


def mime(content_type: Column) -> Column:
    """Content-Type without parameters; missing -> 'no-type'."""
    bare = F.regexp_extract(content_type, r"^[ \t]*([^ \t;,]+)", 1)
    return F.coalesce(F.when(bare != "", bare), F.lit(NO_TYPE))


def mime_top_level(mime_col: Column) -> Column:
    """P5: lower-cased top-level type; anything that is not type/subtype -> 'unknown'."""
    valid = mime_col.rlike(f"^{_TOKEN}/{_TOKEN}$")
    return F.when(valid, F.lower(F.substring_index(mime_col, "/", 1))).otherwise(F.lit(UNKNOWN_TYPE))


def capture_time(fmt: Column, date_raw: Column) -> Column:
    """Capture time as a timestamp. WARC: ISO-8601 (fractional seconds
    accepted); ARC: 14 or 12 digits. Unparseable or absent -> NULL (D6, D17)."""
    warc = F.try_to_timestamp(date_raw, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"))
    arc14 = F.try_to_timestamp(date_raw, F.lit("yyyyMMddHHmmss"))
    arc12 = F.try_to_timestamp(date_raw, F.lit("yyyyMMddHHmm"))
    arc = (F.when(F.length(date_raw) == 14, arc14)
           .when(F.length(date_raw) == 12, arc12))
    return F.when(fmt == "arc", arc).otherwise(warc)


def invalid_date(date_raw: Column, ts: Column) -> Column:
    """A date was present but did not parse (counted, row kept)."""
    return date_raw.isNotNull() & ts.isNull()


def ts14(ts: Column) -> Column:
    """14-digit UTC string."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def cap_content(content: Column, max_bytes: int) -> Column:
    """P10: first ``max_bytes`` bytes of the body, before decoding."""
    return F.substring(content, 1, max_bytes)


def _normalise_charset(name: Column) -> Column:
    up = F.upper(F.trim(name))
    mapped = F.coalesce(F.element_at(F.create_map(*[x for kv in CHARSET_ALIASES.items() for x in map(F.lit, kv)]), up), up)
    return F.when(mapped.isin(KNOWN_CHARSETS), mapped)


def header_charset(content_type: Column) -> Column:
    cs = F.regexp_extract(content_type, r"(?i)charset[ \t]*=[ \t]*[\"']?([^\"';, \t]+)", 1)
    return _normalise_charset(F.when(cs != "", cs))


def meta_charset(content: Column) -> Column:
    """Charset declared by a <meta> tag anywhere in the body."""
    text = F.decode(content, "ISO-8859-1")
    cs = F.regexp_extract(text, r"(?i)<meta[^<>]+charset[ \t]*=[ \t]*[\"']?([-_.:A-Za-z0-9]+)", 1)
    return _normalise_charset(F.when(cs != "", cs))


def sniffed_charset(content: Column, cut: Column | None = None) -> Column:
    """UTF-8 if the bytes are valid UTF-8, else the legacy charset they look like (``functions.charsets``). Where the body was
    ``cut`` (P10), a character that the cut split may be missing its end."""
    valid = F.is_valid_utf8(content.cast("string"))
    if cut is not None:
        n = F.length(content)
        for k in (1, 2, 3):  # the last k bytes begin a longer character
            lead = F.hex(F.substring(content, n - k + 1, F.lit(1))) >= "C2"
            valid = valid | (cut & (n >= k) & lead & F.is_valid_utf8(F.substring(content, F.lit(1), n - k).cast("string")))
    return F.when(valid, F.lit("UTF-8")).otherwise(legacy_charset(content))


def resolve_charset(content_type: Column, content: Column, cut: Column | None = None) -> Column:
    """Header charset; else for HTML a <meta> charset, then byte
    sniffing; everything else UTF-8."""
    is_html = F.lower(F.coalesce(content_type, F.lit(""))).contains("html")
    return F.coalesce(
        header_charset(content_type),
        F.when(is_html, F.coalesce(meta_charset(content), sniffed_charset(content, cut))),
        F.lit("UTF-8"),
    )


def decode_content(content: Column, charset: Column) -> Column:
    """Bytes -> text with the resolved charset; malformed bytes are replaced."""
    return F.call_function("decode", content, charset)
