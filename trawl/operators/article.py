"""Main article text by shallow text features.

The reference calls a boilerplate-removal library. We re-aim it as column
work on the page's block sequence, with the word-count / link-density
decision tree of Kohlschuetter et al. (WSDM 2010):

    c.ld > 1/3                 -> drop
    p.ld <= 0.555556           -> keep if c.words > 16 or n.words > 15 or p.words > 4
    otherwise                  -> keep if c.words > 40 or n.words > 17

(p, c, n = previous, current, next non-empty block; missing neighbours
count as 0 words and density 0.)

A page's blocks all come from one row, so the previous/next lookups are
array lookups inside that row (``transform`` with an index) rather than a
window: no shuffle, and memory is bounded by one capped page. ``blocks``
explodes the same array when a per-block table is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import html as H

# Thresholds of the decision tree.
MAX_LINK_DENSITY = 1.0 / 3.0
PREV_LINK_DENSITY = 0.555556
KEEP_CUR_WORDS_A, KEEP_NEXT_WORDS_A, KEEP_PREV_WORDS_A = 16, 15, 4
KEEP_CUR_WORDS_B, KEEP_NEXT_WORDS_B = 40, 17


def _block_text(fragment: Column) -> Column:
    return H.normalise_ws(H.unescape(H.strip_tags(fragment)))


def _normalised_words(text: Column) -> Column:
    """Word count of whitespace-normalised text (single spaces, trimmed):
    equal to ``word_count`` there, without running a regex."""
    return F.when(text == "", F.lit(0)).otherwise(
        F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def measured_blocks(html: Column) -> Column:
    """array<struct<pos, text, words, anchor_words, ld>> of the non-empty
    blocks of a page, in document order. ``pos`` is the 1-based index of the
    fragment in the raw split."""
    # the block and its anchors go through one expression
    raw = F.transform(H.raw_blocks(html), lambda frag, i: F.struct(
        (i + 1).alias("pos"), F.transform(F.array(frag, H.anchor_html(frag)), _block_text).alias("texts")))
    counted = F.transform(raw, lambda b: F.struct(
        b["pos"].alias("pos"), F.get(b["texts"], 0).alias("text"),
        _normalised_words(F.get(b["texts"], 0)).alias("words"), _normalised_words(F.get(b["texts"], 1)).alias("anchor_words")))
    nonempty = F.filter(counted, lambda b: b["words"] > 0)
    return F.transform(nonempty, lambda b: F.struct(
        b["pos"].alias("pos"), b["text"].alias("text"), b["words"].alias("words"),
        b["anchor_words"].alias("anchor_words"),
        (b["anchor_words"].cast("double") / b["words"].cast("double")).alias("ld")))


def classified_blocks(measured: Column) -> Column:
    """Adds ``keep`` to each block from its own and its neighbours' features.
    ``measured`` must be a column reference: it is read three times per
    block, so it has to be computed once in an earlier projection."""

    def classify(b: Column, i: Column) -> Column:
        prev = F.get(measured, i - 1)
        nxt = F.get(measured, i + 1)
        p_words = F.coalesce(prev["words"], F.lit(0))
        p_ld = F.coalesce(prev["ld"], F.lit(0.0))
        n_words = F.coalesce(nxt["words"], F.lit(0))
        keep = (F.when(b["ld"] > MAX_LINK_DENSITY, F.lit(False))
                .when(p_ld <= PREV_LINK_DENSITY,
                      (b["words"] > KEEP_CUR_WORDS_A) | (n_words > KEEP_NEXT_WORDS_A) | (p_words > KEEP_PREV_WORDS_A))
                .otherwise((b["words"] > KEEP_CUR_WORDS_B) | (n_words > KEEP_NEXT_WORDS_B)))
        return F.struct(b["pos"].alias("pos"), b["text"].alias("text"), b["words"].alias("words"),
                        b["anchor_words"].alias("anchor_words"), b["ld"].alias("ld"), keep.alias("keep"))

    return F.transform(measured, classify)


def article_from_blocks(blocks: Column) -> Column:
    """Kept block texts joined by newlines, in order; '' when none is kept."""
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["keep"]), lambda b: b["text"]), "\n")


def with_blocks(df: DataFrame, html_col: str = "html", out: str = "blocks") -> DataFrame:
    """Adds the classified block array ``out``.

    The measured array comes out of a one-row ``inline`` generator. That
    makes it a real column: Catalyst cannot substitute its expression into
    the classifier (which reads it three times per block) nor into a later
    predicate such as F6's ``wc > 0``; either would repeat the page's whole
    regex pipeline per block (about 10x slower on the test pages)."""
    tmp = f"_{out}_measured"
    measured = df.select("*", F.inline(F.array(F.struct(measured_blocks(F.col(html_col)).alias(tmp)))))
    return measured.select(*[c for c in df.columns if c != out], classified_blocks(F.col(tmp)).alias(out))


def kept_words(blocks: Column) -> Column:
    """P14 of the article without re-tokenising it: kept blocks are
    whitespace-normalised and joined by newlines, so the article's word
    count is the sum of their word counts."""
    return F.aggregate(F.filter(blocks, lambda b: b["keep"]), F.lit(0), lambda acc, b: acc + b["words"])


def with_article(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``article`` and its word count ``wc``."""
    kept = [c for c in df.columns if c not in ("article", "wc")]
    return with_blocks(df, html_col, "_blocks").select(*kept, article_from_blocks(F.col("_blocks")).alias("article"),
                                                       kept_words(F.col("_blocks")).alias("wc"))


def blocks(df: DataFrame, key: str, html_col: str = "html") -> DataFrame:
    """One row per non-empty block: key, pos, words, anchor_words, ld, keep, text."""
    exploded = with_blocks(df, html_col, "_blocks").select(F.col(key), F.explode("_blocks").alias("b"))
    return exploded.select(key, "b.pos", "b.words", "b.anchor_words", "b.ld", "b.keep", "b.text")
