"""URL columns: domain (P9), and links resolved to one normal form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: host of the first http(s) URL in the string, skipping a
# user-info part and stopping at port, path, query or fragment.
HOST_PATTERN = r"(?i)https?://(?:[^/?#@]*@)?([^/:?#]+)"


def host(url: Column) -> Column:
    h = F.regexp_extract(url, HOST_PATTERN, 1)
    return F.when(h != "", h)


def domain(url: Column) -> Column:
    """The host; if it contains ``www`` anywhere (case-sensitive), drop
    everything up to and including its first dot. Not http(s) -> NULL (D2)."""
    h = host(url)
    return F.when(h.contains("www"), F.substring(h, F.instr(h, ".") + 1, 1 << 30)).otherwise(h)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), 0)


def url_parts(link: Column) -> Column:
    """struct<scheme, authority, path, query, fragment> of an http(s) link, absolute or relative: a missing scheme or
    authority is null, query and fragment keep their ``?`` and ``#`` and are '' where there is none.
    Null for another scheme. Blanks around the link and line breaks and tabs within go; ``\\`` in the path is ``/``."""
    clean = F.regexp_replace(F.regexp_replace(link, r"^[\x00- ]+|[\x00- ]+$", ""), r"[\t\n\r]+", "")

    def split(v: Column) -> Column:
        scheme = F.lower(F.regexp_extract(v, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
        rest = F.substring(v, F.when(scheme == "", 1).otherwise(F.length(scheme) + 2), F.length(v))
        return let(F.struct(scheme.alias("scheme"), rest.alias("rest"), F.translate(F.regexp_extract(rest, "^[^?#]*", 0), "\\", "/").alias("head")), parts)

    def parts(s: Column) -> Column:
        # behind a scheme any number of slashes leads to the host
        owned = (s["scheme"] != "") | s["head"].startswith("//")
        return F.when(s["scheme"].isin("", "http", "https"), F.struct(
            F.nullif(s["scheme"], F.lit("")).alias("scheme"), F.when(owned, F.regexp_extract(s["head"], "^/*([^/]*)", 1)).alias("authority"),
            F.when(owned, F.regexp_extract(s["head"], "^/*[^/]*(.*)$", 1)).otherwise(s["head"]).alias("path"),
            F.regexp_extract(s["rest"], r"^[^?#]*(\?[^#]*)", 1).alias("query"), F.regexp_extract(s["rest"], "^[^#]*(#.*)$", 1).alias("fragment")))

    return let(clean, split)


_DOT, _TWO_DOTS = "(?i)^(?:\\.|%2e)$", "(?i)^(?:\\.|%2e){2}$"


def without_dots(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` segments: a fold over the segments with a stack. The cost grows with the
    square of the number of segments, and only for paths that hold such a segment."""
    def push(stack: Column, x: Column) -> Column:
        return (F.when(x.rlike(_TWO_DOTS), F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0))))
                .when(x.rlike(_DOT), stack).otherwise(F.concat(stack, F.array(x))))

    def fold(segments: Column) -> Column:
        # a path that ends in a dot segment names a folder
        last = F.element_at(segments, -1)
        stack = F.aggregate(segments, F.array().cast("array<string>"), push)
        stack = F.when(last.rlike(_DOT) | last.rlike(_TWO_DOTS), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
        return F.concat(F.lit("/"), F.array_join(stack, "/"))

    return F.when(path.rlike("(?i)/(?:[.]|%2e){1,2}(?:/|$)"), let(F.split(F.substring(path, F.lit(2), F.length(path)), "/", -1), fold)).otherwise(path)


def _quoted(text: Column) -> Column:
    """Characters that end a URL in text, percent-encoded. Others, non-ASCII ones included, stay as they are."""
    def quoted(t: Column) -> Column:
        out = t
        for c in ' "<>':
            out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
        return F.when(t.rlike('[ "<>]'), out).otherwise(t)

    return let(text, quoted)


def resolve(base: Column, link: Column) -> Column:
    """The normal form of a link (``url_parts``) on a page with a base (``url_parts``, or null): scheme and host in
    lower case, no default port, no dot segments, ``/`` for an empty path. Null if it is no http(s) URL with a host."""
    def against(b: Column, s: Column) -> Column:
        folder = F.coalesce(F.nullif(F.regexp_extract(b["path"], "^.*/", 0), F.lit("")), F.lit("/"))
        same_page = s["authority"].isNull() & (s["path"] == "")
        return F.struct(
            F.coalesce(s["scheme"], b["scheme"]).alias("scheme"), F.coalesce(s["authority"], b["authority"]).alias("authority"),
            F.when(s["authority"].isNotNull() | s["path"].startswith("/"), s["path"]).when(same_page, b["path"])
            .otherwise(F.concat(folder, s["path"])).alias("path"),
            F.when(same_page & (s["query"] == ""), b["query"]).otherwise(s["query"]).alias("query"), s["fragment"].alias("fragment"))

    def text(u: Column) -> Column:
        owner = F.struct(u["scheme"].alias("scheme"), F.regexp_extract(u["authority"], "^.*@", 0).alias("user"),
                         F.lower(F.regexp_extract(u["authority"], "([^@]*)$", 1)).alias("host"))
        path = F.when(u["path"].startswith("/"), without_dots(u["path"])).otherwise(F.concat(F.lit("/"), u["path"]))
        return F.concat(let(owner, origin), _quoted(F.concat(path, u["query"], u["fragment"])))

    def origin(o: Column) -> Column:
        port = F.when(o["scheme"] == "http", ":80").otherwise(":443")
        bare = F.when(o["host"].endswith(port), F.substring(o["host"], F.lit(1), F.length(o["host"]) - F.length(port))).otherwise(F.rtrim(o["host"], F.lit(":")))
        return let(F.concat(o["scheme"], F.lit("://"), o["user"], bare), lambda x: F.when((o["host"] != "") & ~o["host"].startswith(":"), x))

    return let(against(base, link), text)
