"""Markup as a parser reads it (P12, P15): one ordered scan of a page for start tags.

Comments, the raw text of scripts and the like, and tags with quoted attributes are taken from
left to right, each from where the one before ended, as HTML's tokenizer does; so a tag in a comment, a script or an
attribute value is none. The scan is one regular expression. Its repetitions are possessive: nothing is read twice and
nothing recurses, however long or broken a page is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r" \t\n\r\f"
_STOP = rf"(?=[{_WS}/>])"  # what ends a tag's name
_VALUE = rf"(?:\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z)|[^{_WS}>\"'][^{_WS}>]*+)"
_EQUALS = rf"[{_WS}]*+=[{_WS}]*+"
_ATTRIBUTE = rf"[^{_WS}/>][^{_WS}/>=]*+(?:{_EQUALS}{_VALUE}?+)?+"
_ATTRIBUTES = rf"(?:[{_WS}/]++|{_ATTRIBUTE})*+"
#: Elements whose content is text up to their own end tag, besides title.
_RAW = "script|style|xmp|iframe|noembed|noframes|textarea"

#: Group 1 is a whole token of those wanted: start tags of a, base and svg, end tags of svg, and a title's start tag with its text.
SCAN = (rf"(?is)(<(?:a|base|svg){_STOP}{_ATTRIBUTES}>|</svg{_STOP}{_ATTRIBUTES}>"
        rf"|<title{_STOP}{_ATTRIBUTES}>(?:[^<]++|<(?!/title[{_WS}/>]))*+)"
        r"|<!--(?:-?>|(?:[^-]++|-(?!-!?>))*+(?:--!?>)?+)"
        r"|<(?:[!?]|/[^A-Za-z>])[^>]*+"
        rf"|<({_RAW}){_STOP}{_ATTRIBUTES}>(?:[^<]++|<(?!/\2[{_WS}/>]))*+"
        rf"|</?[A-Za-z][^{_WS}/>]*+{_ATTRIBUTES}")
#: The value of a start tag's first href, with its quotes.
HREF = rf"(?is)^<[A-Za-z][^{_WS}/>]*+(?:[{_WS}/]++|(?!href[{_WS}/>=]){_ATTRIBUTE})*+href{_EQUALS}({_VALUE})"
_TITLE_TAG = rf"(?is)^<title{_ATTRIBUTES}>"


def tokens(html: Column) -> Column:
    """The wanted tokens of a page (``SCAN``), in order."""
    return F.filter(F.regexp_extract_all(html, F.lit(SCAN), F.lit(1)), lambda t: t != "")


def is_tag(token: Column, name: str) -> Column:
    return F.lower(F.substring(token, 2, len(name))).eqNullSafe(F.lit(name)) & F.substring(token, len(name) + 2, 1).rlike(rf"[{_WS}/>]")


def href(tag: Column) -> Column:
    """The raw value of a start tag's first href attribute; '' if it has none."""
    raw = F.regexp_extract(tag, HREF, 1)
    return F.when(raw.rlike("^[\"']"), F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)


def title_text(found: Column) -> Column:
    """The raw text of the first title that is not within an svg; null if there is none."""
    mine = F.filter(found, lambda t: ~(is_tag(t, "a") | is_tag(t, "base")))
    start = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("title"))

    def step(acc: Column, t: Column) -> Column:
        depth = (F.when(t.startswith("</"), F.greatest(acc["depth"] - 1, F.lit(0)))
                 .when(is_tag(t, "svg") & ~t.endswith("/>"), acc["depth"] + 1).otherwise(acc["depth"]))
        title = F.when(acc["title"].isNull() & (acc["depth"] == 0) & is_tag(t, "title"), F.regexp_replace(t, _TITLE_TAG, ""))
        return F.struct(depth.alias("depth"), F.coalesce(acc["title"], title).alias("title"))

    return F.aggregate(mine, start, step)["title"]
