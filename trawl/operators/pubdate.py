"""Publication date of a page.

Candidate lines, in order (D10, D11):
  1. hint is an integer n: the n-th non-empty article line (n < 1 -> first);
  2. hint is text: every HTML line containing it, in order;
  3. the first five non-empty article lines.
The first candidate holding a date mention (P18) gives the date, normalised
strictly (P19); no mention anywhere -> the default ``19700101010100``.
All of it is array work inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.text import date_mention, normalise_mention

# Fixed value: the reference's fallback publication date.
DEFAULT_PUB_DATE = "19700101010100"
FIRST_LINES = 5


def _non_empty_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda l: l != "")


def candidate_lines(html: Column, article: Column, hint: Column) -> Column:
    art = _non_empty_lines(article)
    is_int = hint.rlike("^[0-9]+$")
    n = F.greatest(hint.try_cast("int"), F.lit(1))
    by_number = F.when(is_int & (F.size(art) >= n), F.array(F.get(art, n - 1))).otherwise(
        F.array().cast("array<string>"))
    by_text = F.when(hint.isNotNull() & ~is_int,
                     F.filter(F.split(F.coalesce(html, F.lit("")), "\n"), lambda l: F.instr(l, hint) > 0)
                     ).otherwise(F.array().cast("array<string>"))
    first = F.slice(art, 1, FIRST_LINES)
    return F.concat(F.coalesce(by_number, F.array().cast("array<string>")), by_text, first)


def pub_date(html: Column, article: Column, hint: Column) -> Column:
    mentions = F.filter(F.transform(candidate_lines(html, article, hint), date_mention), lambda m: m.isNotNull())
    first = F.get(mentions, 0)
    return F.when(first.isNull(), F.lit(DEFAULT_PUB_DATE)).otherwise(normalise_mention(first))
