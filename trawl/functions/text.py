"""Text columns: word count (P14) and date mentions / normalising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "[^ \t\n\r\f]+"


def word_count(text: Column) -> Column:
    """Whitespace-separated tokens (space, tab, newline, CR, form feed);
    NULL text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("int")


# The eight date-mention patterns of P18, in priority order.
# DD is a day-or-month field 01-31, S a separator.
_DD = "(0[1-9]|[12][0-9]|3[01])"
_S = "[- /.]"
DATE_MENTION_PATTERNS = [
    f"{_DD}{_S}{_DD}{_S}(19)[0-9][0-9]",
    f"{_DD}{_S}{_DD}{_S}(20)[0-9][0-9]",
    f"(19)[0-9][0-9]{_S}{_DD}{_S}{_DD}",
    f"(20)[0-9][0-9]{_S}{_DD}{_S}{_DD}",
    f"(19)[0-9][0-9]{_DD}{_DD}",
    f"(20)[0-9][0-9]{_DD}{_DD}",
    f"(19)[0-9][0-9]{_S}(0[1-9]|[12][0-9])",
    f"(20)[0-9][0-9]{_S}(0[1-9]|[12][0-9])",
]


def date_mention(text: Column) -> Column:
    """The match of the first pattern (by priority, not by position)
    that occurs anywhere in the text; none -> NULL."""
    hits = [F.regexp_extract(text, p, 0) for p in DATE_MENTION_PATTERNS]
    return F.coalesce(*[F.when(h != "", h) for h in hits])


# The date patterns of P19, in order.
NORMALISE_PATTERNS = [
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "yyyy/MM/dd HH:mm:ss",
    "EEE, MMM d, yyyy",
    "yyyy-MM-dd'T'HH:mm:ss.SSSZ",
    "EEE, MMM. dd, yyyy",
    "EEE, MMM dd, yyyy",
    "yyyyMMdd",
    "EEEEE d MMM yyyy",
    "EEEEE, MMM. dd, yyyy",
    "dd MMM yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "MMM dd, yyyy, HH:mm a",
    "dd.MM.yyyy",
    "MMM dd, yyyy, H:mm a",
    "MMMMM dd, yyyy, HH:mm a",
    "MMMMM dd, yyyy, H:mm a",
    "MMM. dd, yyyy",
    "MMMMM dd, yyyy",
    "EEEEE, MMM. dd, yyyy",
    "EEE, dd MMM yyyy HH:mm:ss z",
    "MMMM dd, yyyy",
    "MMMM dd, yyyy HH:mm a",
    "EEE MMMM dd HH:mm:ss z yyyy",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
]
# Shapes of a mention (P18) once every separator is '-' (D8). Year-month mentions have
# no day and stay NULL.
MENTION_SHAPES = ["dd-MM-yyyy", "yyyy-MM-dd", "yyyyMMdd"]
# Zone names and their offsets.
ZONES = {"Z": "+00:00", "UT": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00",
         "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00", "WET": "+00:00", "CET": "+01:00",
         "CEST": "+02:00", "MEZ": "+01:00", "MESZ": "+02:00", "EET": "+02:00", "EEST": "+03:00"}
_WEEKDAY = r"^(?i:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?[., ]+"
_TIME = "[0-9]{1,2}:[0-9]{2}:[0-9]{2}"
_ZONE = "(?:[A-Za-z]{1,5}|(?:GMT)?[+-][0-9]{2}:?[0-9]{2})"
# The forms that the list's patterns come down to once the weekday is gone: a regex
# over the whole text, and its fields in order, separated by blanks, commas, dots, slashes, colons or dashes.
_NUMERIC = f"^[0-9]{{4}}([/-])[0-9]{{2}}[/-][0-9]{{2}} +{_TIME}$"
WORD_FORMS = [
    (r"^[A-Za-z]+[.]? +[0-9]{1,2}, +[0-9]{4}$", "M d y"),
    (r"^[A-Za-z]+[.]? +[0-9]{1,2}, +[0-9]{4},? +[0-9]{1,2}:[0-9]{2} +[AaPp][Mm]$", "M d y h m a"),
    (r"^[0-9]{1,2} +[A-Za-z]+ +[0-9]{4}$", "d M y"),
    (rf"^[0-9]{{1,2}} +[A-Za-z]+ +[0-9]{{4}} +{_TIME} +{_ZONE}$", "d M y h m s z"),
    (rf"^[A-Za-z]+ +[0-9]{{1,2}} +{_TIME} +{_ZONE} +[0-9]{{4}}$", "M d h m s z y"),
    (rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T{_TIME}[.][0-9]{{3}}(?:Z|[+-][0-9]{{2}}:?[0-9]{{2}})$", "y M d h m s f z"),
]


def _month(field: Column) -> Column:
    return F.coalesce(field.try_cast("int"), _month_by_name(field))


def _zone_offset(zone: Column) -> Column:
    """``+hh:mm`` of a zone name or offset; NULL if unknown."""
    known = F.element_at(F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv]), F.upper(zone))
    offset = F.regexp_replace(zone, "^(?:GMT)?([+-])([0-9]{2}):?([0-9]{2})$", "$1$2:$3")
    return F.coalesce(known, F.when(offset.rlike("^[+-](0[0-9]|1[0-3]):[0-5][0-9]$"), offset))


def _of_form(text: Column, regex: str, fields: str) -> Column:
    """Timestamp (UTC) of a text of one form; no calendar date: NULL."""
    names = fields.split()
    zoned = "z" in names
    # an offset's sign would be lost at the split, so the zone is taken by itself
    zone = F.regexp_extract(text, rf"(?:[ .0-9]|^)({_ZONE}|Z)(?: +[0-9]{{4}})?$", 1) if zoned else None
    body = F.replace(text, zone, F.lit(" ")) if zoned else text
    part = F.split(F.trim(body), "[ ,./:T-]+" if "f" in names else "[ ,.:]+")
    at = {n: F.get(part, i) for i, n in enumerate(n for n in names if n != "z")}
    hour = at["h"].try_cast("int") if "h" in at else F.lit(0)
    if "a" in at:  # a 12-hour clock, whatever the pattern's letter; 13-23 stay as they are
        hour = F.when((hour >= 1) & (hour <= 12), (hour % 12) + F.when(F.upper(at["a"]) == "PM", 12).otherwise(0)).otherwise(hour)
    second = F.concat(at["s"], F.lit("."), at["f"]) if "f" in at else at.get("s", F.lit("0"))
    args = [at["y"].try_cast("int"), _month(at["M"]), at["d"].try_cast("int"), hour, at["m"].try_cast("int") if "m" in at else F.lit(0),
            second.try_cast("decimal(16,6)")]
    made = F.call_function("try_make_timestamp", *args, *([_zone_offset(zone)] if zoned else []))
    return F.when(text.rlike(regex), made)


def normalise_mention(mention: Column) -> Column:
    """P19 of a date mention (P18): 14-digit string of the first shape that parses
    the whole of it, whatever its separators; else NULL."""
    dashed = F.regexp_replace(mention, "[- /.]", "-")
    return F.date_format(F.coalesce(*[F.try_to_timestamp(dashed, F.lit(p)) for p in MENTION_SHAPES]), "yyyyMMddHHmmss")


def date_normalise(text: Column) -> Column:
    """P19, strict: 14-digit UTC string of the first pattern that parses the whole
    text; invalid calendar dates and partial shapes -> NULL. A weekday in front is
    dropped, not checked."""
    bare = F.trim(text)
    named = F.regexp_replace(bare, _WEEKDAY, "")
    words = F.coalesce(*[_of_form(named, regex, fields) for regex, fields in WORD_FORMS])
    timed = F.when(bare.rlike(_NUMERIC), F.try_to_timestamp(F.regexp_replace(bare, "/", "-"), F.lit("yyyy-MM-dd HH:mm:ss")))
    long = F.date_format(F.when(bare.rlike("[A-Za-z]"), words).otherwise(timed), "yyyyMMddHHmmss")
    return F.when(F.length(bare) <= 10, F.coalesce(normalise_mention(bare), long)).otherwise(long)


# The strict pattern list of P20 in the reference's order;
# the LAST one that parses a prefix of the text wins. Each entry: pattern
# name, the regex its prefix must match, and the field each group holds
# (y year, M month number, MMM month name, d day, h hour 1-12, m minute,
# s second, a AM/PM). Numeric fields take any number of digits, as the
# JDK parser does, except in the abutting ``yyyyMMdd``.
LASTWINS_PATTERNS = [
    ("M/dd/yyyy", r"^([0-9]+)/([0-9]+)/([0-9]+)", "M d y"),
    ("dd/MM/yyyy", r"^([0-9]+)/([0-9]+)/([0-9]+)", "d M y"),
    ("dd.M.yyyy", r"^([0-9]+)[.]([0-9]+)[.]([0-9]+)", "d M y"),
    ("M/dd/yyyy hh:mm:ss a", r"^([0-9]+)/([0-9]+)/([0-9]+) ([0-9]+):([0-9]+):([0-9]+) ([AaPp][Mm])", "M d y h m s a"),
    ("dd.M.yyyy hh:mm:ss a", r"^([0-9]+)[.]([0-9]+)[.]([0-9]+) ([0-9]+):([0-9]+):([0-9]+) ([AaPp][Mm])", "d M y h m s a"),
    ("dd.MMM.yyyy", r"^([0-9]+)[.]([A-Za-z]+)[.]([0-9]+)", "d MMM y"),
    ("dd-MMM-yyyy", r"^([0-9]+)-([A-Za-z]+)-([0-9]+)", "d MMM y"),
    ("dd-MM-yyyy", r"^([0-9]+)-([0-9]+)-([0-9]+)", "d M y"),
    ("yyyyMMdd", r"^([0-9]{4})([0-9]{2})([0-9]{2})", "y M d"),
    ("yyyy-MM-dd", r"^([0-9]+)-([0-9]+)-([0-9]+)", "y M d"),
    ("dd.MM.yyyy", r"^([0-9]+)[.]([0-9]+)[.]([0-9]+)", "d M y"),
    ("yyyy/MM/dd", r"^([0-9]+)/([0-9]+)/([0-9]+)", "y M d"),
    ("yyyy.MM.dd", r"^([0-9]+)[.]([0-9]+)[.]([0-9]+)", "y M d"),
]
# English month names, short and long, for MMM.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHS_LONG = ["january", "february", "march", "april", "may", "june", "july",
               "august", "september", "october", "november", "december"]


def _month_by_name(name: Column) -> Column:
    pairs = []
    for i, (short, long_) in enumerate(zip(MONTHS, MONTHS_LONG), start=1):
        pairs += [F.lit(short), F.lit(i)]
        if long_ != short:
            pairs += [F.lit(long_), F.lit(i)]
    return F.element_at(F.create_map(*pairs), F.lower(name))


# The distinct shapes of the list: several patterns read the same one.
LASTWINS_SHAPES = list(dict.fromkeys(regex for _, regex, _ in LASTWINS_PATTERNS))
_ABUTTING = "([0-9]{4})([0-9]{2})([0-9]{2})"


def lastwins_parts(text: Column) -> Column:
    """array<array<string>>: for each distinct shape the fields of the text's prefix
    (NULL where the shape does not match). One regex a shape; make it a column of
    its own before ``lastwins_attempts`` reads it."""
    def parts(regex):
        prefix = F.regexp_extract(text, regex, 0)
        if _ABUTTING in regex:
            fields = F.array(F.substring(prefix, 1, 4), F.substring(prefix, 5, 2), F.substring(prefix, 7, 2))
        else:
            fields = F.split(prefix, "[^0-9A-Za-z]+")
        return F.when(prefix != "", fields)

    return F.array(*[parts(r) for r in LASTWINS_SHAPES])


def _attempt(fields: Column, names: list[str]) -> Column:
    """Parse of one P20 pattern from the fields of its shape."""
    got = {}
    for i, name in enumerate(names):
        raw = F.get(fields, i)
        if name == "a":
            got[name] = F.upper(raw)
        elif name == "MMM":
            got["M"] = _month_by_name(raw)
        else:
            got[name] = raw.try_cast("int")
    hour = F.lit(0)
    if "h" in got:
        # hh is 1-12; 12 AM is hour 0, 12 PM is hour 12
        h = got["h"]
        hour = F.when((h >= 1) & (h <= 12), (h % 12) + F.when(got["a"] == "PM", 12).otherwise(0))
    minute = got.get("m", F.lit(0))
    second = got.get("s", F.lit(0))
    return F.when(fields.isNotNull(), F.call_function("try_make_timestamp", got["y"], got["M"], got["d"], hour, minute,
                                                      second.cast("decimal(16,6)")))


def lastwins_attempts(parts: Column) -> Column:
    """array<timestamp>: the parse of each P20 pattern in list order (NULL where it
    fails) from ``lastwins_parts``. Compute it once into a column, then read both the
    value and the winning pattern from it (``lastwins_value`` /
    ``lastwins_pattern``)."""
    return F.array(*[_attempt(F.get(parts, LASTWINS_SHAPES.index(regex)), fields.split()) for _, regex, fields in LASTWINS_PATTERNS])


def _last_index(attempts: Column) -> Column:
    n = len(LASTWINS_PATTERNS)
    idx = F.filter(F.sequence(F.lit(n), F.lit(1), F.lit(-1)), lambda i: F.element_at(attempts, i).isNotNull())
    return F.get(idx, 0)


def lastwins_value(attempts: Column) -> Column:
    """P20: timestamp from the last pattern in list order that parses a
    prefix of the text (D9: a timestamp, not Date.toString())."""
    i = _last_index(attempts)
    return F.when(i.isNotNull(), F.element_at(attempts, i))


def lastwins_pattern(attempts: Column) -> Column:
    """The pattern that won; NULL if none parsed."""
    names = F.array(*[F.lit(p) for p, _, _ in LASTWINS_PATTERNS])
    i = _last_index(attempts)
    return F.when(i.isNotNull(), F.element_at(names, i))


def date_lastwins(text: Column) -> Column:
    return lastwins_value(lastwins_attempts(lastwins_parts(text)))


def date_lastwins_pattern(text: Column) -> Column:
    return lastwins_pattern(lastwins_attempts(lastwins_parts(text)))
