"""Dictionary entity annotation.

The reference sends each article to a remote entity-linking service. We
re-aim it as a join of the article's word n-grams (lower-case runs of letters
and digits) against a gazetteer ``(spot, title, rho)``: the longest spot
starting at a position wins, of its titles the one with the greatest rho,
and mentions with rho >= 0.3 are kept, in text order.

Plan: the gazetteer becomes one written table of spots. The first-token index made of it has one row
per first token of a spot: the spot that is this token alone, and the lengths of the longer ones. Tokens are
joined with it once, as narrow rows (key, position, token and the few that follow), so longer n-grams are made only
where a spot can begin; those are joined with the longer spots. Neither the page nor a
NULL key takes part, and the article's side is never broadcast (``session.lookup_side``).
The hits move once, by key: the mentions of a document and its line come from the same partition.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trawl.session import Workspace, lookup_side

# Fixed value: relevance threshold.
MIN_RHO = 0.3
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def spots(gazetteer: DataFrame) -> DataFrame:
    """One row per spot: spot (its tokens), n, first (its first token), and the title of greatest rho (of
    equals the first by name)."""
    toks = tokens(F.col("spot"))
    g = gazetteer.select(F.array_join(toks, " ").alias("spot"), F.size(toks).alias("n"), "title", F.col("rho").cast("double").alias("rho"))
    best = F.min_by(F.struct("title", "rho"), F.struct((-F.col("rho")).alias("r"), "title"))
    return (g.where("n > 0 and title is not null and rho is not null").groupBy("spot", "n").agg(best.alias("b"))
            .select("spot", "n", F.substring_index("spot", " ", 1).alias("first"), "b.title", "b.rho"))


class Gazetteer(NamedTuple):
    """``spots`` (written), and of them ``index`` (token, title, rho, lengths), ``long`` (spot, title, rho) and the most tokens of one."""
    spots: DataFrame
    index: DataFrame
    long: DataFrame
    longest: int


def lookup(gazetteer: DataFrame, ws: Workspace) -> Gazetteer:
    """The gazetteer as the joins read it. It is computed here, once: its size decides how it is joined."""
    seen = Observation()
    known = ws.written(spots(gazetteer).observe(seen, F.max("n").alias("longest")), "spots")
    own = lambda c: F.max(F.when(F.col("n") == 1, F.col(c))).alias(c)
    lengths = F.array_sort(F.collect_set(F.when(F.col("n") > 1, F.col("n")))).alias("lengths")
    index = known.groupBy(F.col("first").alias("token")).agg(own("title"), own("rho"), lengths)
    return Gazetteer(known, index, known.where("n > 1").select("spot", "title", "rho"), seen.get["longest"] or 0)


def document_mentions(docs: DataFrame, gazetteer: DataFrame, key: str, text_col: str = "article",
                      min_rho: float = MIN_RHO, ws: Workspace | None = None) -> DataFrame:
    """``key`` and ``mentions``, an array of (pos, n, spot, title, rho) in text order, of every document with one: the
    longest spot at each position, kept if its rho >= ``min_rho``. A null key, text or spot has no mention. The gazetteer is
    written to ``ws`` while the plan is built."""
    known = lookup(gazetteer, ws or Workspace(docs.sparkSession))
    toks = docs.where(F.col(key).isNotNull()).select(F.col(key), F.inline(F.array(F.struct(tokens(F.col(text_col)).alias("_toks")))))
    # a token, its place, and as many that follow as a spot can have
    at = F.inline(F.transform("_toks", lambda t, i: F.struct((i + 1).alias("pos"), t.alias("token"),
                                                             F.slice(F.col("_toks"), i + 2, F.lit(max(known.longest - 1, 0))).alias("_next"))))
    starts = toks.select(key, at).join(lookup_side(known.index, known.spots), "token")
    # a longer spot has the smaller rank
    hit = lambda n, spot, title, rho: F.struct("pos", (-n).alias("rank"), spot.alias("spot"), title.alias("title"), rho.alias("rho"))
    one = F.when(F.col("title").isNotNull(), hit(F.lit(1), F.col("token"), F.col("title"), F.col("rho")))
    if known.longest <= 1:
        hits = starts.select(key, one.alias("m"))
    else:
        tries = starts.select(key, "pos", "token", "_next", one.alias("_one"), F.explode_outer("lengths").alias("n"))
        gram = F.when(F.size("_next") >= F.col("n") - 1, F.concat_ws(" ", F.col("token"), F.slice("_next", F.lit(1), F.col("n") - 1)))
        # where there is no such n-gram the key is one that no spot has, and not the same for all
        gram = F.coalesce(gram, F.concat(F.lit("\x00"), F.xxhash64(key, "pos").cast("string")))
        long = known.long.select(F.col("spot").alias("_gram"), F.col("title").alias("_title"), F.col("rho").alias("_rho"))
        met = tries.select(key, "pos", "_one", "n", gram.alias("_gram")).join(lookup_side(long, known.spots), "_gram", "left")
        hits = met.select(key, F.coalesce(F.when(F.col("_title").isNotNull(), hit(F.col("n"), F.col("_gram"), F.col("_title"), F.col("_rho"))),
                                          F.col("_one")).alias("m"))
    listed = hits.where(F.col("m").isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list("m")).alias("_m"))
    longest = F.filter("_m", lambda m, i: (m["rho"] >= min_rho) & ((i == 0) | (F.get("_m", i - 1)["pos"] != m["pos"])))
    named = F.transform(longest, lambda m: F.struct(m["pos"].alias("pos"), (-m["rank"]).alias("n"), m["spot"].alias("spot"),
                                                    m["title"].alias("title"), m["rho"].alias("rho")))
    return listed.select(key, named.alias("mentions")).where(F.size("mentions") > 0)


def entity_mentions(docs: DataFrame, gazetteer: DataFrame, key: str, text_col: str = "article",
                    min_rho: float = MIN_RHO, ws: Workspace | None = None) -> DataFrame:
    """One row per mention (``document_mentions``): key, pos, n, spot, title, rho."""
    return document_mentions(docs, gazetteer, key, text_col, min_rho, ws).select(key, F.inline("mentions"))


def _entity_line(m: Column) -> Column:
    return F.concat(F.lit("spot: "), m["spot"], F.lit(" title: "), m["title"], F.lit("\n"))


def entity_strings(docs: DataFrame, gazetteer: DataFrame, key: str, text_col: str = "article",
                   min_rho: float = MIN_RHO, ws: Workspace | None = None) -> DataFrame:
    """``key`` and ``entities`` (the ``"spot: S title: T\\n"`` lines in text order) of
    every document with a mention."""
    found = document_mentions(docs, gazetteer, key, text_col, min_rho, ws)
    return found.select(key, F.array_join(F.transform("mentions", _entity_line), "").alias("entities"))


def with_entities(docs: DataFrame, gazetteer: DataFrame, key: str, text_col: str = "article",
                  min_rho: float = MIN_RHO, ws: Workspace | None = None) -> DataFrame:
    """Adds ``entities`` ('' when the document has none). ``key`` must be unique in
    ``docs``, which is used twice: hand in a table, not a costly plan; if it is bucketed by ``key``, only
    the entity strings move."""
    found = entity_strings(docs.select(key, text_col), gazetteer, key, text_col, min_rho, ws)
    return docs.join(found, on=key, how="left").withColumn("entities", F.coalesce("entities", F.lit("")))
