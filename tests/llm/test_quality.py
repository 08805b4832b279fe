import math
import re
from collections import Counter

from tests.llm.conftest import prose
from trawl.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i: i + 8]) for i in range(len(words) - 7))
    marked = {i + k for i in range(len(words) - 7) if windows[tuple(words[i: i + 8])] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup,
            "n_repeat_words": len(marked), "base_failed": n < 20 or 100 * len(marked) > 30 * n}


def test_counts_match_brute_force(spark, docs, no_docs):
    odd = [(1, "a b\xa0c\x1cd e\x85f\n\ng # * é"), (2, " ".join("abcdefghij" * 5)), (3, "x\ny\nx\n \nx\t\n" * 4), (4, "w " * 100), (5, "\x0b\x0c a")]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    want = Counter((r["doc_id"], tuple(brute(r["text"]).values())) for r in both.collect())
    got = Counter((r["doc_id"], (*(r[c] for c in quality.COUNTS), r["base_failed"])) for r in quality.features(both).collect())
    assert got == want
    assert quality.features(no_docs).collect() == []


def test_upper_bound_is_exact():
    for k, n, delta in ((0, 100, 0.05), (3, 50, 0.01), (10, 2000, 0.1)):
        p = quality.upper_bound(k, n, delta)
        tail = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - delta) < 1e-6
    assert quality.upper_bound(5, 5, 0.05) == 1.0 and quality.upper_bound(0, 0, 0.05) == 1.0


def test_copies_are_one_trial(spark):
    """A thousand copies of one good text certify no more than the text itself."""
    rows = [(i, prose(5, 200)) for i in range(1000)] + [(1000 + i, prose(i, 200)) for i in range(20)] \
        + [(2000 + i, " ".join(w + "***" for w in prose(i, 200).split())) for i in range(100)]
    df = spark.createDataFrame(rows + rows[:50], "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 2000), 0) for d, _ in rows], "doc_id long, quality int, toxic int")
    got = quality.verdicts(df, labels).collect()
    assert len(got) == len(rows) + 50 and all(r["kept"] == (not r["base_failed"]) for r in got)


def test_certified_cutoffs_reject_junk_and_keep_good(spark, docs, no_docs):
    rows = [(i, prose(i, 200)) for i in range(1200)] + [(i, " ".join(w + "***" for w in prose(i, 200).split())) for i in range(1200, 1400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i < 1200), 0) for i in range(1400)] + [(0, 0, 0), (7, None, 1), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality.verdicts(df, labels).collect()}
    assert sum(not got[i] for i in range(1200)) <= 24 and not any(got[i] for i in range(1200, 1400))
    # few labels certify nothing: the verdict is the base's
    few = quality.verdicts(docs, labels.where("doc_id < 20")).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in few) and len(few) == docs.count()
    assert quality.verdicts(no_docs, labels).collect() == []
    assert len(quality.verdicts(docs, labels.where("false")).collect()) == docs.count()
