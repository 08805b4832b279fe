import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trawl.llm import lemp

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, doc_id string, score string"


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """docs, items: lists of (id, text); rows (item_id, rank, doc_id, score)."""
    bags = [(d, Counter(words(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df, out = Counter(t for _, b in bags for t in b), []
    for item, text in items:
        scored = []
        for d, b in bags:
            m = 10 + (90 * sum(b.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in set(words(text)) if t in b)
            if s > 0:
                scored.append((-s, d is None, 0 if d is None else d))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k])]
    return out


def items_of(docs):
    r = random.Random(3)
    rows = [d for d in docs if d[1] and len(d[1]) > 40]
    out = [(i, " ".join(r.sample(r.choice(rows)[1].split(), 6))) for i in range(30)]
    out += [(30, None), (31, "?!"), (32, "nowhere"), (33, rows[0][1]), (None, rows[1][1]), (33, rows[0][1]), (34, "One TWO"), (35, "éé one")]
    return out


def test_search_matches_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = items_of(rows)
    found = lemp.search(docs, spark.createDataFrame([(i, t, "clash", "clash") for i, t in items], ITEMS).repartition(3))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == Counter(brute(rows, items))


def test_blocks_of_items_give_the_same(spark, docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = items_of(rows)[:12]
    monkeypatch.setattr(lemp, "BLOCK_TERMS", 20)
    found = lemp.search(docs, spark.createDataFrame([(i, t, None, None) for i, t in items], ITEMS), k=3)
    assert Counter(map(tuple, found.collect())) == Counter(brute(rows, items, 3))


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "one two", None, None)], ITEMS)
    assert lemp.search(docs, none).collect() == [] and lemp.search(no_docs, some).collect() == []


def test_terms_do_not_depend_on_the_pieces(monkeypatch):
    text = ("Ab1é-" * 50 + "x" * 40 + " Ü_\t9").encode()
    whole = [w for part in lemp.terms(text) for w in part]
    monkeypatch.setattr(lemp, "PIECE", 7)
    assert [w for part in lemp.terms(text) for w in part] == whole == [w.encode() for w in words(text.decode())]


@pytest.mark.parametrize("seed", range(3))
def test_pruned_buckets_lose_nothing(seed):
    """Random sparse vectors with many ties: the bounds keep all that reach the best scores."""
    r = np.random.default_rng(seed)
    n, v, k = 3000, 60, 5
    weights = r.integers(0, 9, v)
    sets = [np.sort(r.choice(v, r.integers(1, 9), replace=False)).astype(np.int32) for _ in range(n)]
    xs = [r.integers(1, 2 if i % 3 else 1000, len(s)) for i, s in enumerate(sets)]
    length = np.array([math.sqrt(float((weights[s] * x.astype(float) ** 2).sum())) for s, x in zip(sets, xs)])
    order = np.argsort(-length, kind="stable")
    queries = [np.sort(r.choice(v, 8, replace=False)) for _ in range(10)]
    items = live = [lemp.Item(q, weights, 0, k) for q in queries]
    pruned = 0
    for at in range(0, n, 100):
        pick = order[at:at + 100]
        live = lemp.search_bucket(live, pick.tolist(), length[pick], np.array([len(sets[i]) for i in pick]),
                                  np.concatenate([sets[i] for i in pick]), np.concatenate([xs[i] for i in pick]))
        pruned += len(items) - len(live)
    assert pruned > 0
    for q, it in zip(queries, items):
        score = [int(sum(weights[t] * x for t, x in zip(s, xv) if t in set(q.tolist()))) for s, xv in zip(sets, xs)]
        want = sorted(((-s, i) for i, s in enumerate(score) if s > 0))[:k]
        assert [(-s, d) for s, d in it.best] == want
