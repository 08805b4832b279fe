"""Operator 5, quality rules with risk-controlled thresholds.

Every document gets exact counts of its whole text and from them rule scores
in thousandths. Documents are divided into strata by length. For each stratum
one path of cutoffs runs from lenient to strict, its design taken from one
half of the labelled documents (by hash). On the other half, the holdout, the
steps are tested in that order: the Clopper-Pearson upper bound of the
false-rejection rate (good documents rejected by any rule) must stay below
``alpha`` at confidence 1 - delta / strata (Bonferroni over the strata; within
a path the fixed order needs no correction). The first step that fails ends
the path. Of the certified steps the one with the best junk caught less
``cost`` times good lost is taken. A stratum with no certified step rejects
nothing beyond the base rules.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "bang_rate", "long_words", "short_words"]
STRATA = (50, 150, 500, 2000)  # word counts where the next stratum begins
#: Steps of the path: factors beyond the largest good score, then upper quantiles of the good scores.
MARGINS = (2.0, 1.5, 1.25, 1.1, 1.0)
TAILS = (0.0005, 0.001, 0.0025, 0.005, 0.01)
CHUNK_CHARS = 1 << 20


def repeated_words(ids: np.ndarray, doc: np.ndarray, width: int = 8) -> np.ndarray:
    """For words ``ids`` of documents ``doc`` (both along the text): marks the
    words that lie in a ``width``-word window found twice or more in their
    document. Windows are compared exactly, by ranking pairs of halves."""
    n = len(ids)
    marks = np.zeros(n, bool)
    if n < width:
        return marks
    rank, step = ids.astype(np.int64), 1
    while step < width:
        key = rank[:-step] * (rank.max() + 1) + rank[step:]
        rank = np.unique(key, return_inverse=True)[1]
        step *= 2
    inside = doc[: n - width + 1] == doc[width - 1:]
    at = np.flatnonzero(inside)
    key = doc[at].astype(np.int64) * (rank.max() + 1) + rank[at]
    _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
    hit = at[cnt[inv] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    return np.cumsum(edge[:-1]) > 0


def count_texts(texts: list[str]) -> dict[str, list[int]]:
    """The counts of each text and what the rules need."""
    out = {k: [] for k in [*COUNTS, "n_lines", "n_upper", "n_bangs"]}
    book, ids, sizes = {}, [], []
    for t in texts:
        raw = t.encode("utf-8", "replace")
        words = raw.split()  # bytes split at exactly blank and U+0009..U+000D
        ids.extend([book.setdefault(w, len(book)) for w in words])
        sizes.append(len(words))
        out["n_words"].append(len(words))
        out["word_chars"].append(len(t) - sum(map(t.count, SPACES)))
        out["n_symbols"].append(sum(map(t.count, SYMBOLS)))
        lines = [x for x in t.split("\n") if x.strip(SPACES)]
        out["n_lines"].append(len(lines))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_upper"].append(len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")))
        out["n_bangs"].append(t.count("!"))
    doc = np.repeat(np.arange(len(texts)), sizes)
    marks = repeated_words(np.array(ids, np.int64), doc)
    out["n_repeat_words"] = np.bincount(doc[marks], minlength=len(texts)).tolist()
    return out


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a hash of the text, the counts, the rule scores, base_failed and the stratum, one row per input row."""
    cols = [*COUNTS, "n_lines", "n_upper", "n_bangs"]

    def run(batches):
        for b in batches:
            texts = b.column(1)
            got = {k: [] for k in cols}
            i = 0
            while i < len(texts):
                part, room = [], CHUNK_CHARS  # a longer text goes alone
                while i < len(texts) and (room > 0 or not part):
                    part.append(texts[i].as_py() or "")
                    room -= len(part[-1])
                    i += 1
                for k, v in count_texts(part).items():
                    got[k].extend(v)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *[pa.array(got[k], pa.int64()) for k in cols]], ["doc_id", "text_hash", *cols])

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")) \
        .mapInArrow(run, "doc_id long, text_hash long, " + ", ".join(f"{c} long" for c in cols))
    rate = lambda a, b: F.coalesce((1000.0 * F.col(a) / F.expr(f"nullif({b}, 0)")), F.lit(0.0))
    scored = rows.select(
        "doc_id", "text_hash", *COUNTS, rate("n_symbols", "word_chars").alias("symbol_rate"), rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"), rate("n_upper", "word_chars").alias("upper_rate"),
        rate("n_bangs", "n_words").alias("bang_rate"), rate("word_chars", "n_words").alias("long_words"),
        rate("n_words", "word_chars").alias("short_words"),
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"))
    return scored.withColumn("stratum", sum((F.col("n_words") >= s).cast("int") for s in STRATA))


def upper_bound(errors: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the largest rate at which ``errors`` or fewer of ``n`` still have probability ``delta``."""
    if n == 0 or errors >= n:
        return 1.0
    lo, hi = errors / n, 1.0
    ks = range(errors + 1)
    comb = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) for k in ks]
    for _ in range(50):
        p = (lo + hi) / 2
        cdf = sum(math.exp(c + k * math.log(p) + (n - k) * math.log1p(-p)) for k, c in zip(ks, comb, strict=True)) if p < 1 else 0.0
        lo, hi = (p, hi) if cdf > delta else (lo, p)
    return hi


def choose(labelled: DataFrame, *, alpha: float = 0.02, delta: float = 0.05, cost: float = 10.0) -> dict[int, dict]:
    """Certified cutoffs by stratum from (stratum, rules..., good, holdout): {stratum: {rule: cutoff}}.

    Only aggregates reach the driver: one row per stratum and half.
    """
    design = (labelled.where("good and not holdout").groupBy("stratum")
              .agg(*[F.max(r).alias(f"max_{r}") for r in RULES],
                   *[F.percentile_approx(r, [1 - q for q in TAILS], 10_000).alias(f"q_{r}") for r in RULES])).collect()
    paths = {d["stratum"]: [{r: d[f"max_{r}"] * m for r in RULES} for m in MARGINS]
             + [{r: d[f"q_{r}"][i] for r in RULES} for i in range(len(TAILS))] for d in design}
    n_steps = len(MARGINS) + len(TAILS)

    def rejected(i):
        col = F.lit(None).cast("boolean")
        for s, path in paths.items():
            any_rule = F.lit(False)
            for r, cut in path[i].items():
                any_rule = any_rule | (F.col(r) > F.lit(float(cut)))
            col = F.when(F.col("stratum") == s, any_rule).otherwise(col)
        return col

    tested = labelled.where("holdout").groupBy("stratum", "good").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(rejected(i)).alias(f"r{i}") for i in range(n_steps)]).collect()
    chosen = {}
    for s, path in paths.items():
        good = next((t for t in tested if t["stratum"] == s and t["good"]), None)
        junk = next((t for t in tested if t["stratum"] == s and not t["good"]), None)
        best = 0.0
        for i in range(n_steps):
            if good is None or upper_bound(good[f"r{i}"], good["n"], delta / (len(STRATA) + 1)) > alpha:
                break
            gain = (junk[f"r{i}"] / junk["n"] if junk else 0.0) - cost * good[f"r{i}"] / good["n"]
            if gain > best:
                best, chosen[s] = gain, path[i]
    return chosen


def verdicts(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", **options) -> DataFrame:
    """doc_id, the counts, base_failed, kept (plus the rule scores and the stratum).

    A null text counts as empty (and fails the base). A null doc_id has no
    label but gets a verdict. A document whose label rows disagree, or are
    null, is unlabelled. Repeated rows get the same verdict. The exact bound needs independent trials: each distinct
    text counts once, by a hash, in one half only, and not at all where its copies' labels disagree (near copies still
    count one by one). Other columns
    are not read. Without labels nothing is certified and kept is the base
    verdict; empty documents give an empty result.
    """
    feats = written(features(docs, id_col=id_col, text_col=text_col), "quality")
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("q")).where("q is not null")
             .groupBy("doc_id").agg(F.min("q").alias("lo"), F.max("q").alias("hi")).where("lo = hi and lo in (0, 1)"))
    labelled = (feats.where("not base_failed").join(marks, "doc_id").groupBy("text_hash", "stratum", *RULES)
                .agg(F.min("lo").alias("lo"), F.max("lo").alias("hi")).where("lo = hi")
                .select("stratum", *RULES, (F.col("lo") == 1).alias("good"),
                        (F.pmod(F.xxhash64("text_hash"), F.lit(2)) == 1).alias("holdout")))
    chosen = choose(written(labelled, "quality-labels"), **options)
    reject = F.lit(False)
    for s, cut in chosen.items():
        over = F.lit(False)
        for r, c in cut.items():
            over = over | (F.col(r) > F.lit(float(c)))
        reject = F.when(F.col("stratum") == s, over).otherwise(reject)
    return feats.withColumn("kept", ~F.col("base_failed") & ~reject)
