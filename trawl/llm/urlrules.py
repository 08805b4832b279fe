"""Operator 11 [native], URL filters by association rules.

A short list of host and path rules labels the URLs it fits; the longest rule wins. For the
URLs it does not reach, Spark's FP-growth mines which combinations of URL tokens go with
which label:

* Tokens are the host's labels, its last two labels, the path's words, the query's keys and the scheme,
  each marked with its place. A transaction is a labelled URL's label and its frequent tokens, less those
  that no combination needs: a token whose URLs all have one label says all by itself, one that every URL holds says nothing
  beside others, and tokens held by the very same URLs are one item. A rule with such a token more is no surer than without it.
* Association rules from tokens to a label are pruned by support and confidence, and where a rule of
  fewer tokens says the same at least as surely.
* Rules match by an inverted index: each is posted under its rarest token, the tokens of a URL
  look up the postings, and what is found is verified against all tokens of the rule.
  The surest rule wins, then the one with more support, then ``block``, then fewer tokens,
  then the first by its tokens.

All steps are DataFrame functions and ``pyspark.ml``'s FP-growth; there is no Python worker.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ASCII_LOWER, ASCII_UPPER, Scratch

ALLOW, BLOCK = "allow", "block"
#: The rules of the query as (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Marks a label among a transaction's items; tokens begin with a letter.
LABEL = "="


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' for null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*", 0), ASCII_UPPER, ASCII_LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def rule_struct(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits; null where none does. A rule fits its
    host and all subdomains, if the path starts with the rule's. The list is part of the plan: keep it short."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """The distinct tokens of a URL, sorted; none without a host."""
    def marked(mark: str, found: Column) -> Column:
        return F.transform(F.filter(found, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))

    query = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^?#]*(\?[^#]*)", 1)
    found = F.concat(
        marked("h:", F.split(host_col, r"\.")), marked("d:", F.array(F.substring_index(host_col, ".", -2))),
        marked("p:", F.split(path_col, "[/._-]+")), marked("q:", F.regexp_extract_all(query, F.lit("[?&;]([^=&;]+)"), F.lit(1))),
        marked("s:", F.array(F.lower(F.substring_index(F.coalesce(url, F.lit("")), "://", 1)))))
    return F.when(host_col == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(found)))


def mine(labelled: DataFrame, keep: Scratch, *, min_support: float = 0.005, min_count: int = 5, min_confidence: float = 0.9) -> DataFrame:
    """Rules (antecedent, members, post, verdict, confidence, n) from (_row, tokens, verdict), one row for each labelled URL.

    ``n`` counts the URLs with the antecedent and the verdict: at least ``min_count`` of them and the share ``min_support``
    of all. Every frequent token is mined. A token of the antecedent stands for all of its place in ``members``, the tokens held
    by the same labelled URLs (told by two 64-bit sums over the rows), and the rule is posted under each member. Without labels there are no rules.
    """
    is_block = (F.col("verdict") == BLOCK).cast("long")
    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(is_block), F.lit(0)).alias("b")).first()
    n = int(total["n"])
    least = max(min_count, -(-int(round(min_support * n * 1_000_000)) // 1_000_000), 1)
    each = labelled.select("_row", F.explode("tokens").alias("token"), is_block.alias("b"))
    rows_of = [F.bit_xor(F.xxhash64("_row", F.lit(1))).alias("x"), F.sum(F.xxhash64("_row", F.lit(2)).cast("decimal(38,0)")).alias("s")]
    stats = each.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("b").alias("b"), *rows_of).where(F.col("df") >= least)
    stats = stats.groupBy("df", "b", "x", "s").agg(F.array_sort(F.collect_list("token")).alias("same")) \
        .select(F.get("same", 0).alias("token"), "same", "df", "b", ((F.col("b") > 0) & (F.col("b") < F.col("df")) & (F.col("df") < n)).alias("mixed"))
    stats = keep.written(stats, "url-tokens")
    chosen = each.join(stats.where("mixed").select("token"), "token").groupBy("_row").agg(F.collect_list("token").alias("chosen"))
    label = F.array(F.concat(F.lit(LABEL), F.col("verdict")))
    items = labelled.select("_row", "verdict").join(chosen, "_row", "left") \
        .select(F.concat(F.coalesce("chosen", F.array().cast("array<string>")), label).alias("items"))
    items = keep.written(items, "url-transactions")
    if n == 0:
        found = items.select(F.col("items").alias("antecedent"), F.col("items").alias("consequent"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support"))
    else:
        found = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(items).associationRules
    verdicts = F.array(F.struct(F.lit(BLOCK).alias("verdict"), F.col("b").alias("n")), F.struct(F.lit(ALLOW).alias("verdict"), (F.col("df") - F.col("b")).alias("n")))
    alone = stats.where("not mixed").select(F.array("token").alias("antecedent"), "df", F.inline(verdicts)) \
        .select("antecedent", "verdict", (F.col("n") / F.col("df")).alias("confidence"), "n").where((F.col("n") >= least) & (F.col("confidence") >= min_confidence))
    rules = keep.written(found.where(F.get("consequent", 0).startswith(LABEL)).select(
        F.array_sort("antecedent").alias("antecedent"), F.substring(F.get("consequent", 0), len(LABEL) + 1, 99).alias("verdict"),
        "confidence", F.round(F.col("support") * n).cast("long").alias("n")).unionByName(alone), "url-rules")
    # a rule goes if a part of its tokens says the same at least as surely: it would never be the first that fits. Of the
    # longest ones only parts of one token less are tried
    parts = ("CASE WHEN size(antecedent) > 10 THEN transform(antecedent, y -> array_remove(antecedent, y)) WHEN size(antecedent) > 1 THEN transform(sequence(1, shiftleft(1, size(antecedent)) - 2), "
             "m -> filter(antecedent, (x, i) -> (shiftright(m, i) & 1) = 1)) ELSE array() END")
    smaller = rules.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("sure"))
    needless = (rules.select("antecedent", "verdict", "confidence", F.explode(F.expr(parts)).alias("part"))
                .join(smaller, ["part", "verdict"]).where(F.col("sure") >= F.col("confidence")).select("antecedent", "verdict").distinct())
    rules = rules.join(needless, ["antecedent", "verdict"], "left_anti")
    # posted under the rarest token
    known = rules.select("antecedent", F.posexplode("antecedent").alias("at", "token")).distinct().join(stats.select("token", "same", "df"), "token") \
        .groupBy("antecedent").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "same"))), lambda x: x["same"]).alias("members"),
                                   F.min_by("same", F.struct("df", "token")).alias("posts"))
    return keep.written(rules.join(known, "antecedent").select("antecedent", "members", F.explode("posts").alias("post"), "verdict", "confidence", "n"), "url-rules")


def match(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """(_row, best) of the rows (_row, tokens) that some rule fits; best: struct<verdict, confidence, n, antecedent>."""
    probe = rows.select("_row", F.col("tokens").alias("all_tokens"), F.explode("tokens").alias("post"))
    hits = probe.join(rules, "post").where(F.forall("members", lambda same: F.arrays_overlap(same, F.col("all_tokens"))))
    order = F.struct((-F.col("confidence")).alias("c"), (-F.col("n")).alias("k"), (F.col("verdict") == ALLOW).alias("v"),
                     F.size("antecedent").alias("s"), "antecedent")
    return hits.groupBy("_row").agg(F.min_by(F.struct("verdict", "confidence", "n", "antecedent"), order).alias("best"))


def judge(pages: DataFrame, rules=RULES, *, url_col: str = "url", **mining) -> DataFrame:
    """All columns of ``pages`` plus _host, _path, _rule, _verdict, _confidence and _tokens (of the mined rule).

    ``_rule`` is the listed rule that fits, else null, and then ``_verdict`` is the mined rules', with its
    confidence and tokens, or ``allow`` where none fits. A null URL, or one without ``://``, has an empty host and
    path, no tokens, and is allowed. Repeated rows are judged, and learned from, one by one; an
    empty table gives an empty result, and without labelled URLs nothing is mined. Input columns of the added
    names are replaced. ``mining``: the parameters of ``mine``.
    """
    added = ("_host", "_path", "_rule", "_verdict", "_confidence", "_tokens")
    keep = Scratch(pages.sparkSession)
    url = F.col(f"`{url_col}`").cast("string")
    own = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in added]).alias("_own")
    rows = pages.select(own, url.alias("url"), host(url).alias("host"), path(url).alias("path"))
    rows = rows.withColumn("fit", rule_struct(F.col("host"), F.col("path"), rules))
    # written: a row's number must stay the same however often the table is read
    rows = keep.written(rows.select(F.monotonically_increasing_id().alias("_row"), "_own", "host", "path", "fit",
                                    tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")), "url-rows")
    mined = mine(rows.where("fit is not null").select("_row", "tokens", F.col("fit.verdict").alias("verdict")), keep, **mining)
    best = match(rows.where("fit is null").select("_row", "tokens"), mined)
    out = rows.join(best, "_row", "left")
    verdict = F.coalesce(F.col("fit.verdict"), F.col("best.verdict"), F.lit(ALLOW))
    return out.select("_own.*", F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("fit.rule").alias("_rule"), verdict.alias("_verdict"),
                      F.col("best.confidence").alias("_confidence"), F.col("best.antecedent").alias("_tokens"))
