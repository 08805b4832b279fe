"""HTML columns: title, visible text, links (P12, P15) and the block split
used by the article extractor (P13).

Regex-based on purpose (H4): each step is a built-in expression. Titles and links
are read from one ordered scan of the markup (``functions.markup``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions import markup as M
from trawl.functions.urls import let, resolve, url_parts

WS = "[ \t\n\r\f]"
WS_RUN = "[ \t\n\r\f]+"

# Elements whose content is never visible text. One that is not closed runs to
# the end of the page, as in HTML; so no pattern scans a stretch twice.
INVISIBLE = (r"(?is)<(?:title|script|style|noscript)(?:[ \t\n\r\f][^<>]*)?>.*?(?:</(?:title|script|style|noscript)[ \t\n\r\f]*>|\z)"
             r"|<!--.*?(?:-->|\z)")
# Block-level elements: an opening or closing tag of one of these ends a
# text block.
BLOCK_TAGS = ("address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figcaption|figure"
              "|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section"
              "|table|tbody|td|tfoot|th|thead|tr|ul")
BLOCK_SPLIT = r"(?i)</?(?:" + BLOCK_TAGS + r")(?:[ \t\n\r\f/][^<>]*)?>"
TAG = "<[^<>]*>"
ANCHOR = r"(?is)<a(?:[ \t\n\r\f][^<>]*)?>.*?(?:</a>|\z)"
_SEP, _IS = "\x01", "\x02"


#: Names that pages use most, looked up first.
_FREQUENT = ("amp", "nbsp", "quot", "lt", "gt", "apos", "copy", "middot", "raquo", "laquo", "ndash", "mdash", "hellip")


def _names() -> str:
    """All named character references of HTML as one literal for ``str_to_map``, without the
    semicolon they need. The map is searched in order: the frequent ones come first."""
    from html.entities import html5
    names = [k[:-1] for k in html5 if k.endswith(";")]
    return _SEP.join(f"{k}{_IS}{html5[k + ';']}" for k in sorted(names, key=lambda k: (_FREQUENT + (k,)).index(k)))


def _bare_names() -> dict[str, str]:
    """The old names that are known without a semicolon, longest first."""
    from html.entities import html5
    return {k: html5[k] for k in sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))}


def _map(text: str) -> Column:
    return F.str_to_map(F.lit(text), F.lit(_SEP), F.lit(_IS))


def _code_point(n: Column) -> Column:
    """The character of a numeric reference: 128-159 mean windows-1252 where it has one, as browsers
    read them; what is no character becomes U+FFFD."""
    wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when((n >= 128) & (n <= 159) & ~n.isin(129, 141, 143, 144, 157), F.decode(F.unhex(F.hex(n)), "windows-1252"))
            .when((n <= 0) | (n > 0x10FFFF) | ((n >= 0xD800) & (n <= 0xDFFF)), F.lit("\ufffd")).otherwise(wide))


def _numeric(part: Column) -> Column:
    """What begins with a numeric reference, with it resolved; null where there is none."""
    def known(token: Column) -> Column:
        hexa = F.regexp_extract(token, "^#[xX]0*([0-9A-Fa-f]*)", 1)
        digits = F.when(token.rlike("^#[xX]"), F.conv(hexa, 16, 10)).otherwise(F.regexp_extract(token, "^#0*([0-9]*)", 1))
        # more than seven digits are beyond the last character, whatever they are
        value = F.when((F.length(digits) > 7) | (F.length(hexa) > 6), F.lit(-1)).otherwise(F.coalesce(F.nullif(digits, F.lit("")), F.lit("0")).cast("int"))
        return F.when(token != "", let(value, lambda n: F.concat(_code_point(n), F.substring(part, F.length(token) + 1, F.length(part)))))

    return let(F.regexp_extract(part, "^#(?:[xX][0-9A-Fa-f]+|[0-9]+);?", 0), known)


def _named(part: Column, attribute: bool) -> Column:
    """What begins with a named reference, with it resolved; null where there is none."""
    def rest(name: Column, more: int) -> Column:
        return F.substring(part, F.length(name) + more, F.length(part))

    names = _bare_names()
    # in an attribute, a name without its semicolon that goes on like one, or is followed by =, is text
    bare = f"^({'|'.join(names)})" + ("(?![=A-Za-z0-9])" if attribute else "")
    full = let(F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]{1,31});", 1),
               lambda n: F.when(n != "", F.concat(F.element_at(_map(_names()), n), rest(n, 2))))
    old = let(F.regexp_extract(part, bare, 1),
              lambda n: F.when(n != "", F.concat(F.element_at(_map(_SEP.join(f"{k}{_IS}{v}" for k, v in names.items())), n), rest(n, 1))))
    return F.coalesce(full, old)


def unescape(text: Column, attribute: bool = False) -> Column:
    """Character references -> characters: all named ones of HTML, decimal and
    hexadecimal ones, by the rule for text or for attribute values. Each is resolved once (``&amp;lt;`` stays ``&lt;``);
    a text without an ampersand is returned as it is."""
    def resolved(p: Column, i: Column) -> Column:
        known = F.when(p.startswith("#"), _numeric(p)).otherwise(_named(p, attribute))
        return F.when(i == 0, p).otherwise(F.coalesce(known, F.concat(F.lit("&"), p)))

    return let(text, lambda t: F.when(F.instr(t, "&") > 0, F.array_join(F.transform(F.split(t, "&", -1), resolved), "")).otherwise(t))


def normalise_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WS_RUN, " "))


def title(html: Column) -> Column:
    """The text of the page's title element, entities unescaped, whitespace collapsed; '' if none.
    A title in a comment, a script or an svg is none."""
    raw = let(M.tokens(html), M.title_text)
    return F.when(html.isNotNull(), normalise_ws(unescape(F.coalesce(raw, F.lit("")))))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, TAG, " ")


def visible_text(html: Column) -> Column:
    """Text outside tags, with invisible elements removed."""
    return normalise_ws(unescape(strip_tags(F.regexp_replace(html, INVISIBLE, " "))))


def outlinks(html: Column) -> Column:
    """Distinct http(s) links of a page in normal form, sorted (D15: per page): the first ``href`` of every ``a`` tag,
    references resolved; relative ones only against the page's ``<base href>``."""
    def link(tag: Column) -> Column:
        return F.struct(M.is_tag(tag, "base").alias("base"), url_parts(unescape(M.href(tag), attribute=True)).alias("parts"))

    def absolute(found: Column) -> Column:
        bases = F.filter(found, lambda t: t["base"])
        # the first base; one that is no absolute URL is none
        base = F.get(F.transform(F.slice(bases, 1, 1), lambda t: F.when(t["parts"]["scheme"].isNotNull() & (t["parts"]["authority"] != ""), t["parts"])), 0)
        return let(base, lambda b: F.transform(F.array_distinct(F.filter(found, lambda t: ~t["base"])), lambda t: resolve(b, t["parts"])))

    wanted = F.filter(M.tokens(html), lambda t: (M.is_tag(t, "a") | M.is_tag(t, "base")) & (M.href(t) != ""))
    return F.array_sort(F.array_distinct(F.array_compact(let(F.transform(wanted, link), absolute))))


def raw_blocks(html: Column) -> Column:
    """Split visible HTML into the raw (tagged) block fragments, in order."""
    return F.split(F.regexp_replace(html, INVISIBLE, " "), BLOCK_SPLIT)


def anchor_html(block: Column) -> Column:
    """All anchor elements of a block, concatenated ('' when the block has
    no '<a' / '<A' at all, without running the regex)."""
    has_anchor = (F.instr(block, "<a") > 0) | (F.instr(block, "<A") > 0)
    return F.when(has_anchor, F.array_join(F.regexp_extract_all(block, F.lit(ANCHOR), F.lit(0)), " ")
                  ).otherwise(F.lit(""))
