"""Which legacy charset undeclared bytes are in.

Every candidate decodes the bytes; what it makes of them is scored by validity and by letter sequences: the share of the non-ASCII
bytes that become runs of the script's frequent letters (for syllables and ideographs: its frequent characters), relative
to what plain text of that script shows. Western text is the candidate whose accented letters stand among ASCII ones. The
best score wins; where none is half convincing it is windows-1252. All of it is one expression over the bytes, evaluated only where
nothing is declared and the bytes are no UTF-8.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.urls import let

DEFAULT = "WINDOWS-1252"
# Charset, the sequences that count, bytes of each of their characters, and the share (percent) of the non-ASCII
# bytes that they take in plain text.
CANDIDATES = [
    ("WINDOWS-1252", "[A-Za-z][À-ÿ]|[À-ÿ][a-z]|[‘-”…–—€ «»©®°·]", 1, 90),
    ("WINDOWS-1251", "[оеаинтсрвлкмдпуяыбзг]{2,}", 1, 60),
    ("KOI8-R", "[оеаинтсрвлкмдпуяыбзг]{2,}", 1, 60),
    ("ISO-8859-5", "[оеаинтсрвлкмдпуяыбзг]{2,}", 1, 60),
    ("WINDOWS-1253", "[αοιετσνηυρπκλωςάέίό]{2,}", 1, 60),
    ("WINDOWS-1256", "[اليمونرتبدعسفكقه]{2,}", 1, 60),
    ("SHIFT_JIS", "[ぁ-んァ-ヶー]+", 2, 50),
    ("EUC-JP", "[ぁ-んァ-ヶー]+", 2, 50),
    ("EUC-KR", "[이다는의에을를가은한고로하기지사서도시자인대해그리아어들나있었것라정수과와으니만보일부전제]+", 2, 45),
    ("GB18030", "[的一是不了在人有我他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可里后小么多天能好都然没日于起还发成事只作当想看文无开手十用主行方又如前所本见经头面]", 2, 40),
    ("BIG5", "[的一是不了在人有我他這中大來上國個到說們為子和你地出道也時年得就那要下以生會自著去之過家學對可裡後小麼多天能好都然沒日於起還發成事只作當想看文無開手十用主行方又如前所本見經頭面]", 2, 40),
]


def legacy_charset(content: Column) -> Column:
    """The charset of bytes that are no UTF-8 and have none declared; ``DEFAULT`` where nothing speaks for another."""
    # non-ASCII bytes: what decodes to other characters one by one
    foreign = F.length(F.regexp_replace(F.decode(content, "ISO-8859-1"), "[\\x00-\\x7f]+", ""))

    def score(n: Column, c: Column, i: Column) -> Column:
        def of(text: Column) -> Column:
            broken = F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit("")))
            counted = F.length(F.array_join(F.regexp_extract_all(text, c["letters"], F.lit(0)), "")) * c["bytes"]
            # an accented letter counts with its ASCII neighbour
            counted = F.when(i == 0, F.least(counted, n)).otherwise(counted)
            return F.struct(F.when(broken * 50 > n, F.lit(0.0)).otherwise(100.0 * counted / (n * c["share"])).alias("score"), (-i).alias("rank"), c["name"].alias("name"))

        return let(F.call_function("decode", content, c["name"]), of)

    known = F.array(*[F.struct(F.lit(a).alias("name"), F.lit(b).alias("letters"), F.lit(c).alias("bytes"), F.lit(d).alias("share")) for a, b, c, d in CANDIDATES])
    best = let(foreign, lambda n: F.when(n > 0, F.array_max(F.transform(known, lambda c, i: score(n, c, i)))))
    return let(best, lambda b: F.when(b["score"] >= 0.5, b["name"]).otherwise(F.lit(DEFAULT)))
