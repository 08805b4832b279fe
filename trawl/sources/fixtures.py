"""Inputs derived from the driver tables (FIXTURES.md), as Spark DataFrames.

The driver's ``pages`` carry no HTTP status, headers, MIME type, capture
time, file or offset, so ``capture_records`` derives them from each page
deterministically. The rows have exactly the columns the archive source
emits (``sources.webarchive.RECORD_SCHEMA``), so every operator downstream
runs unchanged on a fixture or on a real archive scan.

``plans.oracle`` writes the same fixtures in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import ensure_conf

CRLF = "\r\n"

# Fixed values of the fixture (FIXTURES.md section 3).
EPOCH_BASE = 1349000000
EPOCH_STEP = 3607
ARC_SUFFIX = ".arc"
# Offset added to the later copy of a capture in the upsert test.
COPY_OFFSET = 100000
# The allow-list holds the domains of pages whose URL contains this.
ALLOW_LIST_MARK = "/en/"
# The upsert test recrawls the pages whose URL contains this (a query).
RECRAWL_MARK = "?"


#: Applied to every table as it is read; nothing unless the benchmark sets it.
prepare = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return prepare(df) if prepare else df


def _case(col: Column, cases: list[tuple[int, str | None]], default) -> Column:
    out = None
    for k, v in cases:
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out.otherwise(F.lit(default))


def capture_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture record per page, in the archive source's schema, plus
    ``page_id`` (kept so tests can join back to the page)."""
    ensure_conf(spark)
    pid = F.col("page_id")
    fmt = F.when(pid % 8 == 3, F.lit("arc")).otherwise(F.lit("warc"))
    record_type = (F.when(pid % 8 == 3, F.lit(None).cast("string"))
                   .when(pid % 9 == 0, F.lit("request"))
                   .when(pid % 9 == 1, F.lit("warcinfo"))
                   .otherwise(F.lit("response")))
    file = F.concat(F.lit("part-"), (pid % 4).cast("string"))
    url = (F.when(pid % 64 == 3, F.concat(F.lit("filedesc://"), file, F.lit(ARC_SUFFIX)))
           .otherwise(F.col("url")))
    status = (F.when(pid % 11 == 0, 404).when(pid % 7 == 0, 301)
              .when(pid % 13 == 0, 500).otherwise(200))
    content_type = _case(pid % 6, [(0, "text/html; charset=utf-8"), (1, "text/html"),
                                   (2, "application/xhtml+xml;charset=UTF-8"),
                                   (3, "image/png"), (4, "garbage")], None)
    epoch = F.when(pid % 17 == 0, F.lit(None).cast("long")).otherwise(F.lit(EPOCH_BASE) + pid * EPOCH_STEP)
    ts = F.timestamp_seconds(epoch)
    date_raw = (F.when(epoch.isNull(), F.lit(None).cast("string"))
                .when((pid % 8 == 3) & (pid % 16 == 11), F.date_format(ts, "yyyyMMddHHmm"))
                .when(pid % 8 == 3, F.date_format(ts, "yyyyMMddHHmmss"))
                .when(pid % 19 == 0, F.lit("not-a-date"))
                .when(pid % 5 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250Z")))
                .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    status_line = F.concat(F.when(pid % 23 == 5, F.lit("HTP/1.1 ")).otherwise(F.lit("HTTP/1.1 ")),
                           status.cast("string"), F.lit(" X" + CRLF))
    head = F.concat(
        status_line,
        F.coalesce(F.concat(F.lit("Content-Type: "), content_type, F.lit(CRLF)), F.lit("")),
        F.lit("Server: fixture" + CRLF),
        F.when(pid % 5 == 2, F.lit("CONTENT-TYPE: text/html; charset=ISO-8859-1" + CRLF)).otherwise(F.lit("")),
    )
    return table(spark, sf_dir, "pages").select(
        pid.alias("page_id"),
        file.alias("file"),
        pid.alias("rec_offset"),
        F.lit(0).alias("rec_index"),
        fmt.alias("format"),
        record_type.alias("record_type"),
        url.alias("url"),
        date_raw.alias("date_raw"),
        head.alias("http_head"),
        F.encode(F.col("html"), "UTF-8").alias("content"),
    )


# By page_id modulo their number, the charset a page is written in without declaring it, and a sentence of its body.
LEGACY_TEXTS = [
    ("WINDOWS-1251", "Сегодня в городе открылась новая выставка, на которой показаны работы молодых художников."),
    ("SHIFT_JIS", "今日は天気がいいので、公園まで散歩に行きました。そこでたくさんの花を見ることができました。"),
    ("EUC-KR", "오늘은 날씨가 좋아서 공원까지 산책을 갔습니다. 그곳에서 많은 사람들을 볼 수 있었습니다."),
    ("WINDOWS-1252", "Für die Größe der Bäume gibt es schöne Gründe, und über Äpfel weiß man vieles; déjà vu à l'été."),
    ("EUC-JP", "この町には古い建物がたくさん残っていて、毎年おおくの人がおとずれます。"),
    ("GB18030", "今天我们在北京的一个地方看到了很多人，他们都说这是中国最大的新闻。"),
    ("KOI8-R", "Правительство приняло решение о том, что все школы страны получат новые учебники."),
    ("WINDOWS-1253", "Σήμερα ο καιρός είναι πολύ καλός και πήγαμε στο πάρκο με τα παιδιά."),
    ("BIG5", "今天我們在台北的一個地方看到了很多人，他們都說這是最大的新聞。"),
]


def legacy_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page for each of ``pages`` in a charset that neither its header nor its markup names: page_id, made (the charset),
    text, content_type, content."""
    ensure_conf(spark)
    k = F.col("page_id") % len(LEGACY_TEXTS)
    one = lambda value: _case(k, [(i, value(t)) for i, t in enumerate(LEGACY_TEXTS)], None)
    html = F.concat(F.lit("<html><head><title>"), F.col("page_id").cast("string"), F.lit("</title></head><body><p class=\"text\">"),
                    one(lambda t: t[1]), F.lit("</p></body></html>"))
    return table(spark, sf_dir, "pages").select("page_id", one(lambda t: t[0]).alias("made"), html.alias("text"), F.lit("text/html").alias("content_type")) \
        .withColumn("content", F.call_function("encode", F.col("text"), F.col("made")))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow-list: the distinct domains of the English pages (URL path
    under ``/en/``)."""
    from trawl.functions.urls import domain
    pages = table(spark, sf_dir, "pages")
    return (pages.where(F.col("url").contains(ALLOW_LIST_MARK))
            .select(domain(F.col("url")).alias("domain"))
            .where(F.col("domain").isNotNull()).distinct())


def domain_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hint per allow-listed domain: line number '2' when the domain's
    length is even, else the substring 'Stand'."""
    d = domains(spark, sf_dir)
    return d.select("domain", F.when(F.length("domain") % 2 == 0, F.lit("2")).otherwise(F.lit("Stand")).alias("hint"))


# The eight shapes an order date is written in, by o_orderkey % 8.
DATED_SHAPES = ["dd.MM.yyyy", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy-MM-dd",
                "yyyy/MM/dd", "yyyyMMdd", "yyyy.MM.dd", "yyyy-MM"]


def dated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``'Stand ' || d || ' Uhr'`` with d = o_orderdate in one of 8 shapes."""
    ensure_conf(spark)
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 8
    d = None
    for i, shape in enumerate(DATED_SHAPES):
        v = F.date_format(F.col("o_orderdate"), shape)
        d = F.when(k == i, v) if d is None else d.when(k == i, v)
    return o.select(F.col("o_orderkey"), F.concat(F.lit("Stand "), d, F.lit(" Uhr")).alias("text"))


# Links put in front of a page, and what they mean below BASE_HREF.
BASE_HREF = "http://base.example/dir/page?x=1"
LINK_MARKUP = ('<base href="http://base.example/dir/page?x=1"><a href="/rel">z</a><a class=k href=up/two.html>u</a>'
               "<A HREF='//other.example/q?a=1&amp;b=2'>v</A><a href=\"?only=query\">w</a><a href=\"mailto:x@y.example\">m</a>"
               '<a href="?a=1&section=3&copy=2&region=de&amp;x=&copy;">e</a><a title="a>b" href=../up/./x>p</a>'
               "<a href='HTTP://Quoted.example:80'>q</a><a name=href>n</a>")
LINK_TARGETS = ["http://base.example/rel", "http://base.example/dir/up/two.html", "http://other.example/q?a=1&b=2",
                "http://base.example/dir/page?only=query", "http://base.example/dir/page?a=1&section=3&copy=2&region=de&x=\u00a9",
                "http://base.example/up/x", "http://quoted.example/"]
# Fixed value: markup that is no link, in front of every page.
NO_LINKS = ('<!-- <a href="http://comment.example/">c</a> --><script>var s = "<a href=\'http://script.example/\'>";</script>'
            '<div title="<a href=http://value.example/>">d</div><textarea><a href="http://text.example/"></textarea>')


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with links in front: two to their own URL, and the fixed ones below a
    ``<base>`` on the pages with an https URL (the driver's pages hold relative links only, which
    without a base are none)."""
    p = table(spark, sf_dir, "pages")
    own = F.concat(F.lit('<a href="'), F.col("url"), F.lit('">x</a><a href='), F.col("url"), F.lit(">y</a>"))
    based = F.when(F.col("url").startswith("https"), F.lit(LINK_MARKUP)).otherwise(F.lit('<a href="/rel">z</a>'))
    return p.select("page_id", "url", F.concat(F.lit(NO_LINKS), own, based, F.col("html")).alias("html"))


# Character references put into every page's title and after its first
# heading, and what they mean; and what comes before the title.
NO_TITLE = '<!-- <title>no</title> --><svg viewBox="0 > 1"><title>no</title></svg><script>"<title>no</title>"</script>'
REF_TITLE, REF_TITLE_MEANS = "M&uuml;nchen &#8211; &#x20AC;5 &amp;lt; AT&ampT ", "M\u00fcnchen \u2013 \u20ac5 &lt; AT&T "
REF_WORDS = "F&uuml;r &#8222;uns&#8220; kostet der Weg nach K&ouml;ln heute nur noch &#x35; &euro; und zwar f&#252;r alle die &copy; 2012 &unknown; da waren"
REF_WORDS_MEANS = ("F\u00fcr \u201euns\u201c kostet der Weg nach K\u00f6ln heute nur noch 5 \u20ac und zwar f\u00fcr alle die \u00a9 2012 &unknown; da waren")


def reference_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with character references of every kind in title and article, and titles that are none before the title."""
    p = table(spark, sf_dir, "pages")
    html = F.replace(F.col("html"), F.lit("<title>"), F.lit(NO_TITLE + "<title>" + REF_TITLE))
    html = F.replace(html, F.lit("</h1>"), F.lit(f"</h1><p>{REF_WORDS}</p>"))
    return p.select("page_id", "url", html.alias("html"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(spot, title, rho)``: each distinct lower-cased first title word;
    title = that word with its first letter upper-cased; rho =
    (length(spot) % 10) / 10. Each of these spots is ambiguous: it has a second title
    (``... 2``) with rho 0.35. The first five title tokens (letters, digits) are a spot too, rho 0.9."""
    from trawl.functions.html import title
    # the generator makes the title a column of its own, computed once a page
    p = table(spark, sf_dir, "pages").select(F.inline(F.array(F.struct(F.lower(title(F.col("html"))).alias("t")))))
    upper = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))
    first = F.get(F.split(F.col("t"), " "), 0)
    toks = F.regexp_extract_all(F.col("t"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    five = F.when(F.size(toks) >= 5, F.array_join(F.slice(toks, 1, 5), " "))
    # both kinds of spot from one reading of the pages
    spots = p.select(F.inline(F.array(F.struct(F.lit(True).alias("word"), first.alias("spot")), F.struct(F.lit(False).alias("word"), five.alias("spot"))))).where("spot <> ''").distinct()
    own = F.struct(upper(F.col("spot")).alias("title"), F.when(F.col("word"), (F.length("spot") % 10) / F.lit(10.0)).otherwise(0.9).alias("rho"))
    second = F.struct(F.concat(upper(F.col("spot")), F.lit(" 2")).alias("title"), F.lit(0.35).alias("rho"))
    return spots.select("spot", F.inline(F.when(F.col("word"), F.array(own, second)).otherwise(F.array(own))))


def _shape_by(key: Column, value: Column, shapes: list[str]) -> Column:
    out = None
    for i, shape in enumerate(shapes):
        v = F.date_format(value, shape)
        out = F.when(key % len(shapes) == i, v) if out is None else out.when(key % len(shapes) == i, v)
    return out


def lastwins_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date strings for the last-wins parser (P20), from ``o_orderdate``:
    a 12-hour clock form for keys divisible by 5, a month-name form for keys
    divisible by 3, otherwise one of the eight shapes of ``dated_text``."""
    ensure_conf(spark)
    o = table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = (F.when(k % 5 == 0, F.date_format(d, "M/dd/yyyy hh:mm:ss a"))
            .when(k % 3 == 0, F.date_format(d, "dd-MMM-yyyy"))
            .otherwise(_shape_by(k, d, DATED_SHAPES)))
    return o.select("o_orderkey", text.alias("text"))


# An order date written in every shape of the date list, by o_orderkey
# modulo their number: the shape, and what goes with it. Times are 15:04:05.
LONG_SHAPES = [
    ("yyyy/MM/dd HH:mm:ss", "", "150405"), ("yyyy/MM/dd", "", "000000"), ("EEE, MMM d, yyyy", "", "000000"),
    ("yyyy-MM-dd'T'HH:mm:ss'.250+0200'", "", "130405"), ("EEE, MMM. dd, yyyy", "", "000000"), ("EEE, MMM dd, yyyy", "", "000000"),
    ("yyyyMMdd", "", "000000"), ("EEEE d MMM yyyy", "", "000000"), ("EEEE, MMM. dd, yyyy", "", "000000"), ("dd MMM yyyy", "", "000000"),
    ("yyyy-MM-dd HH:mm:ss", "", "150405"), ("MMM dd, yyyy, hh:mm a", "", "150400"), ("dd.MM.yyyy", "", "000000"),
    ("MMM dd, yyyy, h:mm a", "", "150400"), ("MMMM dd, yyyy, hh:mm a", "", "150400"), ("MMMM dd, yyyy, h:mm a", "", "150400"),
    ("MMM. dd, yyyy", "", "000000"), ("MMMM dd, yyyy", "", "000000"), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "", "150405"),
    ("MMMM dd, yyyy HH:mm 'PM'", "", "150400"), ("EEE MMMM dd HH:mm:ss 'EST' yyyy", "", "200405"), ("dd/MM/yyyy", "", "000000"),
    ("dd-MM-yyyy", "", "000000"), ("yyyy/MM/dd", " junk", None), ("MMMM 32, yyyy", "", None), ("yyyy-MM", "", None),
]


def long_dated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order date in one of the long shapes (``LONG_SHAPES``)."""
    ensure_conf(spark)
    o = table(spark, sf_dir, "orders")
    at = F.date_trunc("DAY", F.col("o_orderdate").cast("timestamp")) + F.expr("interval '15:04:05' hour to second")
    text = _shape_by(F.col("o_orderkey"), at, [s for s, _, _ in LONG_SHAPES])
    tail = F.element_at(F.array(*[F.lit(t) for _, t, _ in LONG_SHAPES]), (F.col("o_orderkey") % len(LONG_SHAPES) + 1).cast("int"))
    return o.select("o_orderkey", "o_orderdate", F.concat(text, tail).alias("text"))


# Dated pages put 'Stand <date> Uhr' after the first </h1>,
# the date being 1992-01-01 plus 37 days per page id.
DATED_PAGES_START = "1992-01-01"
DATED_PAGES_STEP_DAYS = 37


def dated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one dated paragraph right after the first heading (the
    driver's pages hold no date strings)."""
    ensure_conf(spark)
    p = table(spark, sf_dir, "pages")
    pid, html = F.col("page_id"), F.col("html")
    day = F.date_add(F.lit(DATED_PAGES_START).cast("date"), (pid * DATED_PAGES_STEP_DAYS).cast("int"))
    line = F.concat(F.lit("<p>Stand "), _shape_by(pid, day, DATED_SHAPES), F.lit(" Uhr</p>"))
    at = F.instr(html, "</h1>")
    dated = F.when(at > 0, F.concat(F.substring(html, F.lit(1), at + 4), line,
                                    F.substring(html, at + 5, F.lit(1 << 30)))).otherwise(html)
    return p.select("page_id", "url", dated.alias("html"))


# ---- archives that the package's writer does not make --------------------------

#: Pages whose member is damaged: the last bytes of the gzip trailer are changed.
CORRUPT_MODULUS, CORRUPT_REST = 10, 7
#: Bytes of records after which a task begins another file.
ODD_FILE_BYTES = 64 << 20


def odd_archive(spark: SparkSession, sf_dir: str, path: str, kind: str) -> str:
    """The capture records as archives of another make, a file per task and ``ODD_FILE_BYTES``
    of records: ``whole`` (one gzip member for all records of a file), ``corrupt`` (some members with a
    wrong checksum) or ``arc`` (short dates, very long URLs). A file is written as its records come."""
    from trawl.sources import webarchive as W
    W.register(spark)

    def write(batches):
        import uuid
        import zlib

        import pyarrow as pa
        fs, base = W._fs_and_path(path)
        n, room, f, z = 0, 0, None, None
        for b in batches:
            for r in b.to_pylist():
                n += 1
                if kind == "arc":
                    rec = W.arc_record(r["url"], r["date_raw"], W.mime_of_head(r["http_head"]), r["http_head"], r["content"])
                else:
                    rec = W.warc_record(r["url"], r["date_raw"], r["record_type"], r["http_head"], r["content"])
                if f is None:
                    fs.create_dir(base, recursive=True)
                    f = fs.open_output_stream(f"{base}/{uuid.uuid4().hex}.{'arc' if kind == 'arc' else 'warc'}.gz", compression=None)
                    room, z = ODD_FILE_BYTES, zlib.compressobj(wbits=31)
                room -= len(rec)
                if kind != "whole":
                    rec = W.gzip_member(rec)
                if kind == "corrupt" and r["page_id"] % CORRUPT_MODULUS == CORRUPT_REST:
                    rec = rec[:-1] + bytes([rec[-1] ^ 1])
                f.write(z.compress(rec) if kind == "whole" else rec)
                if room <= 0:
                    f = _ended(f, z if kind == "whole" else None)
        _ended(f, z if kind == "whole" else None)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    def _ended(f, member):
        if f is not None:
            f.write(member.flush() if member else b"")
            f.close()

    recs = capture_records(spark, sf_dir)
    if kind == "arc":
        pid, plain = F.col("page_id"), ~F.col("url").startswith("filedesc")
        recs = recs.withColumn("date_raw", F.when(pid % 3 == 0, F.substring("date_raw", 1, 4)).otherwise(F.col("date_raw")))
        recs = recs.withColumn("url", F.when((pid % 3 == 1) & plain, F.concat("url", F.lit("#"), F.repeat(F.lit("0123456789"), 600))).otherwise(F.col("url")))
    recs.mapInArrow(write, "n long").count()
    return path
