"""DuckDB SQL for every registered query: the correctness oracle.

The fixtures are re-derived in SQL from the same driver tables. Where the
fixture fixes a value (status, the winning Content-Type, the capture
time), the oracle states that value directly instead of re-parsing the
HTTP head, so the Spark parsers are checked against the definition. The
text operators (blocks, article, n-grams) are written the SQL way: unnest
and ``lag``/``lead`` windows, where Spark works inside the row.
"""

from __future__ import annotations

from trawl.sources import fixtures as FX

# Values of the definitions, stated here and not taken from the engine.
BLANK_RUN = "[ \t\n\r\f]+"
WORD = "[^ \t\n\r\f]+"
TAG = "<[^<>]*>"
HIDDEN = (r"(?is)<(?:title|script|style|noscript)(?:[ \t\n\r\f][^<>]*)?>.*?(?:</(?:title|script|style|noscript)[ \t\n\r\f]*>|\z)"
          r"|<!--.*?(?:-->|\z)")
BLOCK_TAG = (r"(?i)</?(?:address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6"
             r"|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)(?:[ \t\n\r\f/][^<>]*)?>")
ANCHOR = r"(?is)<a(?:[ \t\n\r\f][^<>]*)?>.*?(?:</a>|\z)"
PAGE_TITLE = "<title>([^<]*)</title>"  # the driver's pages have one, in plain markup
HOST = r"(?i)https?://(?:[^/?#@]*@)?([^/:?#]+)"
MIME_TOKEN = r"[!#$%&'*+.^_`|~0-9A-Za-z-]+"
DAY, SEP = "(0[1-9]|[12][0-9]|3[01])", "[- /.]"
MENTIONS = [f"{DAY}{SEP}{DAY}{SEP}19[0-9][0-9]", f"{DAY}{SEP}{DAY}{SEP}20[0-9][0-9]", f"19[0-9][0-9]{SEP}{DAY}{SEP}{DAY}",
            f"20[0-9][0-9]{SEP}{DAY}{SEP}{DAY}", f"19[0-9][0-9]{DAY}{DAY}", f"20[0-9][0-9]{DAY}{DAY}",
            f"19[0-9][0-9]{SEP}(0[1-9]|[12][0-9])", f"20[0-9][0-9]{SEP}(0[1-9]|[12][0-9])"]
LAST_WINS = [
    ("M/dd/yyyy", r"^(\d+)/(\d+)/(\d+)", "M d y"), ("dd/MM/yyyy", r"^(\d+)/(\d+)/(\d+)", "d M y"), ("dd.M.yyyy", r"^(\d+)\.(\d+)\.(\d+)", "d M y"),
    ("M/dd/yyyy hh:mm:ss a", r"^(\d+)/(\d+)/(\d+) (\d+):(\d+):(\d+) ([AaPp][Mm])", "M d y h m s a"),
    ("dd.M.yyyy hh:mm:ss a", r"^(\d+)\.(\d+)\.(\d+) (\d+):(\d+):(\d+) ([AaPp][Mm])", "d M y h m s a"),
    ("dd.MMM.yyyy", r"^(\d+)\.([A-Za-z]+)\.(\d+)", "d MMM y"), ("dd-MMM-yyyy", r"^(\d+)-([A-Za-z]+)-(\d+)", "d MMM y"),
    ("dd-MM-yyyy", r"^(\d+)-(\d+)-(\d+)", "d M y"), ("yyyyMMdd", r"^(\d{4})(\d{2})(\d{2})", "y M d"), ("yyyy-MM-dd", r"^(\d+)-(\d+)-(\d+)", "y M d"),
    ("dd.MM.yyyy", r"^(\d+)\.(\d+)\.(\d+)", "d M y"), ("yyyy/MM/dd", r"^(\d+)/(\d+)/(\d+)", "y M d"), ("yyyy.MM.dd", r"^(\d+)\.(\d+)\.(\d+)", "y M d"),
]
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
NO_DATE, FIRST_LINES = "19700101010100", 5


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NL = "chr(10)"
CRLF = "chr(13) || chr(10)"


# ---- scalar building blocks ---------------------------------------------------

def unesc(x: str) -> str:
    """Character references by HTML's own table: split at ampersands, look each one up."""
    from html.entities import html5
    full = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
    # the test tables hold a handful of names; the lookup has all of them
    table = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in full.items()) + "}"
    bare = "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k)))
    name = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]{1,31});', 1)"
    dec, hexa = "regexp_extract(p, '^#([0-9]{1,9});?', 1)", "regexp_extract(p, '^#[xX]([0-9A-Fa-f]{1,7});?', 1)"
    old = f"regexp_extract(p, {lit('^(' + bare + ')')}, 1)"
    one = (f"CASE WHEN {dec} <> '' THEN chr(CAST({dec} AS INTEGER)) || regexp_replace(p, '^#[0-9]{{1,9}};?', '') "
           f"WHEN {hexa} <> '' THEN chr(CAST('0x' || {hexa} AS INTEGER)) || regexp_replace(p, '^#[xX][0-9A-Fa-f]{{1,7}};?', '') "
           f"WHEN {name} <> '' AND {table}[{name}] IS NOT NULL THEN {table}[{name}] || substr(p, length({name}) + 2) "
           f"WHEN {old} <> '' THEN {table}[{old}] || substr(p, length({old}) + 1) ELSE '&' || p END")
    return f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {one} END), '')"


def norm(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit(BLANK_RUN)}, ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(TAG)}, ' ', 'g')"


def wc(x: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({x}, {lit(WORD)})), 0) AS INTEGER)"


def title(h: str) -> str:
    return norm(unesc(f"regexp_extract({h}, {lit(PAGE_TITLE)}, 1)"))


def visible(h: str) -> str:
    return norm(unesc(strip(f"regexp_replace({h}, {lit(HIDDEN)}, ' ', 'g')")))


def domain(u: str) -> str:
    h = f"nullif(regexp_extract({u}, {lit(HOST)}, 1), '')"
    return f"(CASE WHEN contains({h}, 'www') THEN substr({h}, instr({h}, '.') + 1) ELSE {h} END)"


def mime(ct: str) -> str:
    return f"coalesce(nullif(regexp_extract({ct}, {lit(r'^[ \t]*([^ \t;,]+)')}, 1), ''), 'no-type')"


def mime_top(m: str) -> str:
    return (f"(CASE WHEN regexp_matches({m}, {lit('^' + MIME_TOKEN + '/' + MIME_TOKEN + '$')}) "
            f"THEN lower(split_part({m}, '/', 1)) ELSE 'unknown' END)")


def latin1(x: str) -> str:
    """Text whose UTF-8 bytes are read back as ISO-8859-1."""
    b = f"encode({x})"
    return (f"array_to_string(list_transform(range(0, octet_length({b})), lambda i: "
            f"chr(TRY_CAST('0x' || substr(hex({b}), 2 * i + 1, 2) AS INTEGER))), '')")


def mention(x: str) -> str:
    parts = [f"nullif(regexp_extract({x}, {lit(p)}, 0), '')" for p in MENTIONS]
    return f"coalesce({', '.join(parts)})"


def normalise(m: str) -> str:
    r = f"regexp_replace({m}, '[- /.]', '-', 'g')"
    tries = ", ".join(f"try_strptime({r}, '{p}')" for p in ("%d-%m-%Y", "%Y-%m-%d", "%Y%m%d"))
    return f"strftime(coalesce({tries}), '%Y%m%d%H%M%S')"


def _month(x: str) -> str:
    whens = []
    for i, name in enumerate(MONTHS, start=1):
        whens += [f"WHEN {lit(n)} THEN {i}" for n in dict.fromkeys((name[:3], name))]
    return f"(CASE lower({x}) {' '.join(whens)} END)"


def _lastwins_attempt(x: str, regex: str, fields: str) -> str:
    g = {}
    for i, name in enumerate(fields.split(), start=1):
        raw = f"regexp_extract({x}, {lit(regex)}, {i})"
        if name == "a":
            g["a"] = f"upper({raw})"
        elif name == "MMM":
            g["M"] = _month(raw)
        else:
            g[name] = f"TRY_CAST({raw} AS INTEGER)"
    hour = "0"
    if "h" in g:
        hour = (f"(CASE WHEN {g['h']} BETWEEN 1 AND 12 THEN {g['h']} % 12 + "
                f"(CASE WHEN {g['a']} = 'PM' THEN 12 ELSE 0 END) END)")
    minute, second = g.get("m", "0"), g.get("s", "0")
    return (f"(CASE WHEN regexp_matches({x}, {lit(regex)}) THEN "
            f"try(make_timestamp({g['y']}, {g['M']}, {g['d']}, {hour}, {minute}, {second})) END)")


def lastwins(x: str) -> tuple[str, str]:
    attempts = [(name, _lastwins_attempt(x, regex, fields)) for name, regex, fields in LAST_WINS]
    ts = f"coalesce({', '.join(a for _, a in reversed(attempts))})"
    pat = f"coalesce({', '.join(f'CASE WHEN {a} IS NOT NULL THEN {lit(n)} END' for n, a in reversed(attempts))})"
    return ts, pat


# ---- fixtures -----------------------------------------------------------------

def _shape_sql(key: str, value: str, n: int = len(FX.DATED_SHAPES)) -> str:
    fmt = {"dd.MM.yyyy": "%d.%m.%Y", "dd/MM/yyyy": "%d/%m/%Y", "dd-MM-yyyy": "%d-%m-%Y",
           "yyyy-MM-dd": "%Y-%m-%d", "yyyy/MM/dd": "%Y/%m/%d", "yyyyMMdd": "%Y%m%d",
           "yyyy.MM.dd": "%Y.%m.%d", "yyyy-MM": "%Y-%m"}
    whens = " ".join(f"WHEN {i} THEN strftime({value}, '{fmt[s]}')" for i, s in enumerate(FX.DATED_SHAPES))
    return f"(CASE {key} % {n} {whens} END)"


RECS = f"""
src AS (
  SELECT page_id, url AS page_url, html,
    CASE WHEN page_id % 11 = 0 THEN 404 WHEN page_id % 7 = 0 THEN 301
         WHEN page_id % 13 = 0 THEN 500 ELSE 200 END AS fx_status,
    CASE page_id % 6 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'text/html'
         WHEN 2 THEN 'application/xhtml+xml;charset=UTF-8' WHEN 3 THEN 'image/png'
         WHEN 4 THEN 'garbage' ELSE NULL END AS fx_ct,
    CASE WHEN page_id % 17 = 0 THEN NULL
         ELSE make_timestamp(CAST({FX.EPOCH_BASE} + page_id * {FX.EPOCH_STEP} AS BIGINT) * 1000000) END AS fx_ts
  FROM pages),
recs AS (
  SELECT page_id,
    'part-' || CAST(page_id % 4 AS VARCHAR) AS file,
    page_id AS rec_offset,
    CASE WHEN page_id % 8 = 3 THEN 'arc' ELSE 'warc' END AS format,
    CASE WHEN page_id % 8 = 3 THEN NULL WHEN page_id % 9 = 0 THEN 'request'
         WHEN page_id % 9 = 1 THEN 'warcinfo' ELSE 'response' END AS record_type,
    CASE WHEN page_id % 64 = 3 THEN 'filedesc://part-' || CAST(page_id % 4 AS VARCHAR) || '{FX.ARC_SUFFIX}'
         ELSE page_url END AS url,
    CASE WHEN fx_ts IS NULL THEN NULL
         WHEN page_id % 8 = 3 AND page_id % 16 = 11 THEN strftime(fx_ts, '%Y%m%d%H%M')
         WHEN page_id % 8 = 3 THEN strftime(fx_ts, '%Y%m%d%H%M%S')
         WHEN page_id % 19 = 0 THEN 'not-a-date'
         WHEN page_id % 5 = 0 THEN strftime(fx_ts, '%Y-%m-%dT%H:%M:%S') || '.250Z'
         ELSE strftime(fx_ts, '%Y-%m-%dT%H:%M:%SZ') END AS date_raw,
    (CASE WHEN page_id % 23 = 5 THEN 'HTP/1.1 ' ELSE 'HTTP/1.1 ' END) || CAST(fx_status AS VARCHAR) || ' X' || {CRLF}
      || coalesce('Content-Type: ' || fx_ct || {CRLF}, '') || 'Server: fixture' || {CRLF}
      || CASE WHEN page_id % 5 = 2 THEN 'CONTENT-TYPE: text/html; charset=ISO-8859-1' || {CRLF} ELSE '' END
      AS http_head,
    html AS page_html,
    CASE WHEN page_id % 23 = 5 THEN NULL ELSE fx_status END AS status,
    CASE WHEN page_id % 5 = 2 THEN 'text/html; charset=ISO-8859-1' ELSE fx_ct END AS content_type,
    CASE WHEN fx_ts IS NULL THEN NULL
         WHEN page_id % 8 = 3 AND page_id % 16 = 11 THEN date_trunc('minute', fx_ts)
         WHEN page_id % 8 = 3 THEN fx_ts
         WHEN page_id % 19 = 0 THEN NULL
         WHEN page_id % 5 = 0 THEN fx_ts + INTERVAL 250 MILLISECOND
         ELSE fx_ts END AS ts
  FROM src),
snaps AS (
  SELECT *, {mime('content_type')} AS mime,
    ((format = 'arc' AND (url IS NULL OR starts_with(url, 'filedesc://')))
      OR (record_type IS NOT NULL AND record_type <> 'response')) AS is_header,
    CASE WHEN page_id % 5 = 2 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS charset,
    CASE WHEN page_id % 5 = 2 THEN {latin1('page_html')} ELSE page_html END AS html
  FROM recs)"""

OK = """
ok AS (
  SELECT *, strftime(ts, '%Y%m%d%H%M%S') AS ts14,
         coalesce(strftime(ts, '%Y%m%d%H%M%S'), '') || url AS id
  FROM (SELECT *, {dom} AS domain FROM snaps
        WHERE NOT is_header AND status IS NOT NULL AND status = 200) t
  WHERE domain IS NOT NULL)""".replace("{dom}", domain("url"))


REF_PAGES = f"""
refp AS (SELECT page_id, replace(replace(html, '<title>', {lit(FX.NO_TITLE + '<title>' + FX.REF_TITLE)}), '</h1>',
                                 {lit('</h1><p>' + FX.REF_WORDS + '</p>')}) AS html, html AS plain FROM pages)"""


def domains_cte() -> str:
    return f"""
domains AS (
  SELECT DISTINCT {domain('url')} AS domain FROM pages
  WHERE contains(url, {lit(FX.ALLOW_LIST_MARK)}) AND {domain('url')} IS NOT NULL)"""


def gram_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


def gazetteer_cte() -> str:
    return f"""
gaz_raw AS (
  SELECT spot, title, rho FROM (
    SELECT spot, upper(substr(spot, 1, 1)) || substr(spot, 2) AS title, CAST(length(spot) % 10 AS DOUBLE) / 10.0 AS rho FROM g1
    UNION ALL SELECT spot, upper(substr(spot, 1, 1)) || substr(spot, 2) || ' 2' AS title, 0.35 AS rho FROM g1
    UNION ALL SELECT spot, upper(substr(spot, 1, 1)) || substr(spot, 2) AS title, 0.9 AS rho FROM g5) g),
gaz AS (
  SELECT spot, title, rho FROM (
    SELECT *, row_number() OVER (PARTITION BY spot ORDER BY rho DESC, title) AS best
    FROM (SELECT array_to_string({gram_tokens('spot')}, ' ') AS spot, title, rho FROM gaz_raw) n WHERE spot <> '') b
  WHERE best = 1)"""


def gazetteer_words() -> str:
    return f"""
gw AS (SELECT string_split(lower({title('html')}), ' ') AS w FROM pages),
g1 AS (SELECT DISTINCT w[1] AS spot FROM gw WHERE w[1] <> ''),
g5 AS (SELECT DISTINCT array_to_string(k[1:5], ' ') AS spot FROM (SELECT {gram_tokens(title('html'))} AS k FROM pages) t WHERE len(k) >= 5)"""


def article_ctes(src: str, key: str, html: str, prefix: str = "a") -> str:
    """Blocks -> classified -> ``{prefix}_art(key, article, wc)`` for every row of src."""
    return f"""
{prefix}_frags AS (
  SELECT {key}, unnest(parts) AS frag, generate_subscripts(parts, 1) AS pos
  FROM (SELECT {key}, string_split_regex(regexp_replace({html}, {lit(HIDDEN)}, ' ', 'g'),
                                          {lit(BLOCK_TAG)}) AS parts FROM {src}) s),
{prefix}_blk AS (
  SELECT {key}, pos, txt, {wc('txt')} AS words, {wc('atxt')} AS anchor_words
  FROM (SELECT {key}, pos, {norm(unesc(strip('frag')))} AS txt,
               {norm(unesc(strip(f"array_to_string(regexp_extract_all(frag, {lit(ANCHOR)}), ' ')")))} AS atxt
        FROM {prefix}_frags) f),
{prefix}_cls AS (
  SELECT {key}, pos, txt, words, anchor_words,
    CASE WHEN ld > {1.0 / 3.0!r} THEN false
         WHEN coalesce(lag(ld) OVER w, 0.0) <= 0.555556
           THEN words > 16 OR coalesce(lead(words) OVER w, 0) > 15
                OR coalesce(lag(words) OVER w, 0) > 4
         ELSE words > 40 OR coalesce(lead(words) OVER w, 0) > 17 END AS keep
  FROM (SELECT *, CAST(anchor_words AS DOUBLE) / CAST(words AS DOUBLE) AS ld
        FROM {prefix}_blk WHERE words > 0) b
  WINDOW w AS (PARTITION BY {key} ORDER BY pos)),
{prefix}_art AS (
  SELECT s.{key}, coalesce(a.article, '') AS article, {wc("coalesce(a.article, '')")} AS wc
  FROM {src} s LEFT JOIN (
    SELECT {key}, string_agg(txt, {NL} ORDER BY pos) AS article
    FROM {prefix}_cls WHERE keep GROUP BY {key}) a ON s.{key} = a.{key})"""


def entity_ctes(docs: str, key: str, text: str, gaz: str = "gaz", prefix: str = "e") -> str:
    """-> ``{prefix}_best(key, pos, n, spot, title, rho)`` and ``{prefix}_str(key, entities)``."""
    return f"""
{prefix}_toks AS (SELECT {key}, {gram_tokens(text)} AS tk FROM {docs} d),
{prefix}_grams AS (
  SELECT {key}, pos, n, array_to_string(list_slice(tk, pos, pos + n - 1), ' ') AS spot
  FROM (SELECT {key}, tk, n, unnest(range(1, len(tk) - n + 2)) AS pos
        FROM (SELECT {key}, tk, n FROM {prefix}_toks, (SELECT DISTINCT len(string_split(spot, ' ')) AS n FROM {gaz}) l) t) g),
{prefix}_best AS (
  SELECT {key}, pos, n, spot, title, rho FROM (
    SELECT g.{key}, g.pos, g.n, g.spot, z.title, z.rho,
           row_number() OVER (PARTITION BY g.{key}, g.pos ORDER BY g.n DESC) AS rn
    FROM {prefix}_grams g JOIN {gaz} z ON g.spot = z.spot) h
  WHERE rn = 1 AND rho >= 0.3),
{prefix}_str AS (
  SELECT {key}, string_agg('spot: ' || spot || ' title: ' || title || {NL}, '' ORDER BY pos) AS entities
  FROM {prefix}_best GROUP BY {key})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


# ---- queries --------------------------------------------------------------------

def _reason(url_pattern=None, mime_pattern=None, success=False) -> str:
    parts = ["WHEN is_header THEN 'SkippedWarcType'"]
    if url_pattern is not None:
        parts.append(f"WHEN NOT coalesce(regexp_full_match(url, {lit(url_pattern)}), false) THEN 'SkippedUrl'")
    parts.append("WHEN status IS NULL THEN 'Skipped'")
    if mime_pattern is not None:
        parts.append(f"WHEN NOT regexp_full_match(mime, {lit(mime_pattern)}) THEN 'SkippedMimeType'")
    if success:
        parts.append("WHEN status >= 300 THEN 'SkippedHttpStatus'")
    return f"(CASE {' '.join(parts)} ELSE 'Matched' END)"


def _sql() -> dict[str, str]:
    from trawl.plans.queries import AUDIT_OPTIONS, CONTENT_CAP_QUERY_BYTES, SCAN_OPTIONS
    q: dict[str, str] = {}
    q["domain"] = f"SELECT page_id, url, {domain('url')} AS domain FROM pages"
    q["title"] = (f"SELECT page_id, rtrim({lit(FX.REF_TITLE_MEANS)} || {title('html')}) AS title FROM pages")
    q["word_count"] = f"SELECT page_id, {wc(visible('html'))} AS wc FROM pages"
    q["document_word_count"] = f"SELECT doc_id, {wc('text')} AS wc FROM documents"

    # every link of a page is relative: the navigation's, in plain markup; under a base
    # each of them becomes a link of the base's host
    nav = "list_transform(regexp_extract_all(html, '<a href=\"(/[^\"]*)\">', 1), lambda l: 'http://base.example' || l)"
    fixed = "[" + ", ".join(lit(x) for x in FX.LINK_TARGETS) + "]"
    linked = (f"linked AS (SELECT page_id, url, list_sort(list_distinct(CASE WHEN starts_with(url, 'https') "
              f"THEN list_concat([url], {fixed}, {nav}) ELSE [url] END)) AS links FROM pages)")
    q["outlinks"] = (f"WITH {linked} SELECT page_id, array_to_string(links, ' ') AS links, "
                     f"CAST(len(links) AS INTEGER) AS n_links FROM linked")
    edges = "edges AS (SELECT url AS src, unnest(links) AS link FROM linked)"
    q["link_edges"] = f"WITH {linked}, {edges} SELECT src, link FROM edges"
    q["distinct_links"] = (f"WITH {linked}, {edges} SELECT link, CAST(count(DISTINCT src) AS BIGINT) AS in_degree "
                           f"FROM edges GROUP BY link")

    blocks = article_ctes("pages", "page_id", "html")
    q["article_blocks"] = f"{with_(blocks)} SELECT page_id, CAST(pos AS INTEGER) AS pos, words, anchor_words, keep FROM a_cls"
    ref = article_ctes("refm", "page_id", "html")
    means = (f"refm AS (SELECT page_id, replace(plain, '</h1>', {lit('</h1><p>' + FX.REF_WORDS_MEANS.replace('&', '&amp;') + '</p>')}) AS html FROM refp)")
    q["article_text"] = f"{with_(REF_PAGES, means, ref)} SELECT page_id, article, wc FROM a_art"
    ents = entity_ctes("a_art", "page_id", "article")
    q["entity_mentions"] = (f"{with_(blocks, gazetteer_words(), gazetteer_cte(), ents)} "
                            f"SELECT page_id, CAST(pos AS INTEGER) AS pos, spot, title, rho FROM e_best")
    q["entity_string"] = (f"{with_(blocks, gazetteer_words(), gazetteer_cte(), ents)} SELECT a.page_id, coalesce(s.entities, '') "
                          f"AS entities FROM a_art a LEFT JOIN e_str s ON a.page_id = s.page_id")

    q["capture_ts14"] = "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') AS ts14 FROM orders"
    dated = f"dated AS (SELECT o_orderkey, 'Stand ' || {_shape_sql('o_orderkey', 'o_orderdate')} || ' Uhr' AS text FROM orders)"
    q["date_mention"] = f"WITH {dated} SELECT o_orderkey, {mention('text')} AS mention FROM dated"
    q["date_normalize"] = (f"WITH {dated}, m AS (SELECT o_orderkey, {mention('text')} AS mention FROM dated) "
                           f"SELECT o_orderkey, mention, {normalise('mention')} AS normalized FROM m")
    ln = len(FX.LONG_SHAPES)
    times = " ".join(f"WHEN {i} THEN {'NULL' if t is None else lit(t)}" for i, (_, _, t) in enumerate(FX.LONG_SHAPES))
    q["date_normalize_long"] = (f"SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || (CASE o_orderkey % {ln} {times} END) AS normalized FROM orders")
    lw_text = (f"lw AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%-m/%d/%Y %I:%M:%S %p') "
               f"WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d-%b-%Y') "
               f"ELSE {_shape_sql('o_orderkey', 'o_orderdate')} END AS text FROM orders)")
    lw_ts, lw_pat = lastwins("text")
    q["date_lastwins"] = (f"WITH {lw_text} SELECT o_orderkey, text, strftime({lw_ts}, '%Y-%m-%d %H:%M:%S') AS parsed, "
                          f"{lw_pat} AS pattern FROM lw")

    day = f"(DATE '{FX.DATED_PAGES_START}' + CAST(page_id * {FX.DATED_PAGES_STEP_DAYS} AS INTEGER))"
    dp = (f"dp AS (SELECT page_id, url, CASE WHEN instr(html, '</h1>') > 0 THEN "
          f"substr(html, 1, instr(html, '</h1>') + 4) || '<p>Stand ' || {_shape_sql('page_id', day)} || ' Uhr</p>' "
          f"|| substr(html, instr(html, '</h1>') + 5) ELSE html END AS html FROM pages)")
    hints = (f"hints AS (SELECT domain, CASE WHEN length(domain) % 2 = 0 THEN '2' ELSE 'Stand' END AS hint "
             f"FROM domains)")
    dph = f"dph AS (SELECT d.*, h.hint FROM (SELECT *, {domain('url')} AS domain FROM dp) d LEFT JOIN hints h ON d.domain = h.domain)"
    isint = "regexp_matches(hint, '^[0-9]+$')"
    nth = "greatest(TRY_CAST(hint AS INTEGER), 1)"
    cand = (f"cand AS (SELECT page_id, domain, hint, list_concat("
            f"CASE WHEN {isint} AND len(al) >= {nth} THEN [al[{nth}]] ELSE CAST([] AS VARCHAR[]) END, "
            f"CASE WHEN hint IS NOT NULL AND NOT {isint} THEN list_filter(string_split(coalesce(html, ''), {NL}), "
            f"lambda l: instr(l, hint) > 0) ELSE CAST([] AS VARCHAR[]) END, list_slice(al, 1, {FIRST_LINES})) AS cands "
            f"FROM (SELECT d.*, list_filter(string_split(a.article, {NL}), lambda l: l <> '') AS al "
            f"FROM dph d JOIN p_art a ON d.page_id = a.page_id) x)")
    ment = f"ment AS (SELECT *, list_filter(list_transform(cands, lambda c: {mention('c')}), lambda m: m IS NOT NULL) AS ms FROM cand)"
    q["pub_date"] = (f"{with_(dp, domains_cte(), hints, dph, article_ctes('dph', 'page_id', 'html', 'p'), cand, ment)} "
                     f"SELECT page_id, domain, hint, CASE WHEN len(ms) = 0 THEN '{NO_DATE}' "
                     f"ELSE {normalise('ms[1]')} END AS pub_date FROM ment")

    q["pub_date_list"] = q["pub_date"]

    base = with_(RECS)
    q["mime_type"] = f"{base} SELECT page_id, content_type, mime FROM snaps"
    q["mime_top_level"] = f"{base} SELECT page_id, mime, {mime_top('mime')} AS mime_top FROM snaps"
    q["http_headers"] = (f"{base} SELECT page_id, status, content_type, "
                         f"CAST(CASE WHEN content_type IS NULL THEN 1 ELSE 2 END AS INTEGER) AS n_headers, "
                         f"CASE WHEN content_type IS NULL THEN 'server: fixture' "
                         f"ELSE 'content-type: ' || content_type || {NL} || 'server: fixture' END AS headers FROM snaps")
    q["capture_time"] = (f"{base} SELECT page_id, format, date_raw, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, "
                         f"(date_raw IS NOT NULL AND ts IS NULL) AS invalid_date FROM snaps")
    nl, sentences = len(FX.LEGACY_TEXTS), " ".join(f"WHEN {i} THEN {len(t)}" for i, (_, t) in enumerate(FX.LEGACY_TEXTS))
    made = " ".join(f"WHEN {i} THEN {lit(c)}" for i, (c, _) in enumerate(FX.LEGACY_TEXTS))
    around = len('<html><head><title></title></head><body><p class="text"></p></body></html>')
    q["charset_decode"] = (f"{base} SELECT page_id, CAST(NULL AS VARCHAR) AS made, charset, CAST(length(html) AS INTEGER) AS n_chars, "
                           f"(html = page_html) AS same_text FROM snaps UNION ALL "
                           f"SELECT page_id, CASE page_id % {nl} {made} END AS made, CASE page_id % {nl} {made} END AS charset, "
                           f"CAST({around} + length(CAST(page_id AS VARCHAR)) + CASE page_id % {nl} {sentences} END AS INTEGER) AS n_chars, true AS same_text FROM pages")
    cap = CONTENT_CAP_QUERY_BYTES
    q["content_cap"] = (f"{base} SELECT page_id, CAST(least(octet_length(encode(page_html)), {cap}) AS INTEGER) AS n_bytes, "
                        f"substr(hex(encode(page_html)), 1, {2 * cap}) AS head_hex FROM snaps")
    so = SCAN_OPTIONS
    q["scan_filters"] = (f"{base} SELECT page_id, url, mime, status FROM snaps WHERE "
                         f"{_reason(so['url_pattern'], so['mime_pattern'], True)} = 'Matched'")
    audit = _reason(mime_pattern=AUDIT_OPTIONS["mime_pattern"])
    q["scan_audit"] = (f"{base}, r AS (SELECT *, {audit} AS reason FROM snaps) "
                       f"SELECT reason, count(*) AS n FROM r GROUP BY reason UNION ALL "
                       f"SELECT 'InvalidDate' AS reason, count(*) AS n FROM r "
                       f"WHERE reason = 'Matched' AND date_raw IS NOT NULL AND ts IS NULL")
    bad = f"page_id % {FX.CORRUPT_MODULUS} = {FX.CORRUPT_REST}"
    q["quarantine"] = (f"{base} SELECT url, 'no HTTP status line' AS quarantine_reason FROM snaps "
                       f"WHERE (record_type IS NULL OR record_type = 'response') AND status IS NULL "
                       f"UNION ALL SELECT NULL AS url, 'corrupt gzip member' AS quarantine_reason FROM snaps WHERE {bad}")
    q["status_counts"] = (f"{base} SELECT status, count(*) AS n FROM snaps "
                          f"WHERE {_reason()} = 'Matched' GROUP BY status")
    q["mime_counts"] = (f"{base} SELECT {mime_top('mime')} AS mime_top, count(*) AS n FROM snaps "
                        f"WHERE {_reason()} = 'Matched' AND status = 200 GROUP BY 1")

    okb = with_(RECS, OK, article_ctes("ok", "page_id", "html", "k"))
    q["run_stats"] = (f"{okb} SELECT count(*) AS matched, count(*) FILTER (WHERE wc = 0) AS failed FROM k_art")
    q["domain_allowlist"] = (f"{with_(RECS, OK, domains_cte())} SELECT page_id, url, domain FROM ok "
                             f"WHERE domain IN (SELECT domain FROM domains)")
    q["domain_list_scan"] = f"{with_(domains_cte())} SELECT domain FROM domains"
    listed = "listed AS (SELECT * FROM ok WHERE domain IN (SELECT domain FROM domains))"
    capped = ("capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY rec_offset) AS rn "
              "FROM ok WHERE domain IN (SELECT domain FROM domains)) c WHERE rn <= 10)")
    q["cap_per_file"] = f"{with_(RECS, OK, domains_cte(), capped)} SELECT file, rec_offset, url FROM capped"
    q["text_rows"] = (f"{with_(RECS, OK, domains_cte(), listed, article_ctes('listed', 'page_id', 'html', 't'))} "
                      f"SELECT c.file, c.rec_offset, coalesce(c.ts14, '') || {NL} || t.article AS value "
                      f"FROM listed c JOIN t_art t ON c.page_id = t.page_id WHERE t.wc > 0")
    latest = ("docs AS (SELECT * FROM (SELECT o.*, k.article, k.wc, row_number() OVER "
              "(PARTITION BY o.id ORDER BY o.file DESC, o.rec_offset DESC) AS rn "
              "FROM ok o JOIN k_art k ON o.page_id = k.page_id WHERE k.wc > 0) d WHERE rn = 1)")
    q["doc_project"] = (f"{with_(RECS, OK, article_ctes('ok', 'page_id', 'html', 'k'), latest, gazetteer_words(), gazetteer_cte(), entity_ctes('docs', 'page_id', 'article'))} "
                        f"SELECT d.ts14 AS ts, d.url, d.id, d.domain, d.wc, d.html, coalesce(s.entities, '') AS entities "
                        f"FROM docs d LEFT JOIN e_str s ON d.page_id = s.page_id")

    arch = (f"{base} SELECT url, format, record_type, date_raw, "
            f"CASE WHEN format = 'arc' AND starts_with(url, 'filedesc://') THEN NULL ELSE status END AS status, "
            f"CASE WHEN format = 'arc' AND starts_with(url, 'filedesc://') "
            f"THEN md5(http_head || {CRLF} || page_html) ELSE md5(page_html) END AS content_md5, "
            f"CAST(NULL AS VARCHAR) AS error FROM snaps")
    q["warc_roundtrip"] = arch
    q["warc_split_exact"] = arch
    q["doc_upsert"] = (f"{okb} SELECT o.id, o.url, o.file, CASE WHEN contains(o.url, {lit(FX.RECRAWL_MARK)}) "
                       f"THEN o.rec_offset + {FX.COPY_OFFSET} ELSE o.rec_offset END AS rec_offset, k.wc "
                       f"FROM ok o JOIN k_art k ON o.page_id = k.page_id WHERE k.wc > 0")
    q["json_lines"] = (f"{with_(RECS, OK)} SELECT url, ts14 AS ts, mime AS type, status AS s, "
                       f"CAST(length(html) AS INTEGER) AS c_chars FROM ok")
    q["text_export"] = (f"{with_(RECS, OK, domains_cte(), listed, article_ctes('listed', 'page_id', 'html', 't'))} "
                        f"SELECT unnest(string_split(coalesce(c.ts14, '') || {NL} || t.article, {NL})) AS value "
                        f"FROM listed c JOIN t_art t ON c.page_id = t.page_id WHERE t.wc > 0")
    settings = "(SELECT unnest(['one whole', 'one capped', 'many whole', 'many capped']) AS setting) s"
    warc = (f"odd AS (SELECT page_id, url, date_raw, md5(page_html) AS content_md5 FROM snaps)")
    q["warc_whole_gzip"] = (f"{base}, {warc} SELECT setting, url, date_raw, content_md5, CAST(NULL AS VARCHAR) AS error FROM odd, {settings}")
    q["warc_corrupt"] = (f"{base}, {warc} SELECT setting, url, date_raw, content_md5, CAST(NULL AS VARCHAR) AS error FROM odd, {settings} "
                         f"UNION ALL SELECT setting, NULL AS url, NULL AS date_raw, NULL AS content_md5, 'corrupt gzip member' AS error "
                         f"FROM odd, {settings} WHERE {bad}")
    q["arc_split_exact"] = (
        f"{base} SELECT setting, CASE WHEN page_id % 3 = 1 AND NOT starts_with(url, 'filedesc') THEN url || '#' || repeat('0123456789', 600) ELSE url END AS url, "
        f"CASE WHEN page_id % 3 = 0 THEN substr(date_raw, 1, 4) ELSE date_raw END AS date_raw, "
        f"CASE WHEN starts_with(url, 'filedesc') THEN md5(http_head || {CRLF} || page_html) ELSE md5(page_html) END AS content_md5, "
        f"CAST(NULL AS VARCHAR) AS error FROM snaps, {settings}")
    return q


def oracle_sql() -> dict[str, str]:
    return _sql()
