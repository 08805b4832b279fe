import math
import re
from collections import defaultdict

import pytest

from trawl.llm import mixing


def targets(sizes):
    """Brute force: sizes by source, in order."""
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        room = total - sum(capped.values())
        t = {s: room * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] >= 2 * sizes[s]]
        if not over:
            return {**capped, **t}
        capped.update({s: 2.0 * sizes[s] for s in over})
        if len(over) == len(free):
            return capped


def test_mix_meets_targets_and_reruns_agree(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and rows[0]["_row"] == "clash"
    size = defaultdict(int)
    for r in rows:
        assert r["_size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        size[r["source"]] += r["_size"]
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = targets({s: size[s] for s in order})
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["_source_size"] == size[r["source"]] and r["_target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["_copies"] <= 2
        taken[r["source"]] += r["_copies"] * r["_size"]
        largest[r["source"]] = max(largest[r["source"]], r["_size"])
    for s in order:
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["_copies"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_rates_solve_the_dual(spark):
    hist = spark.createDataFrame([(1, 10, 50), (1, 100, 20), (1, 3000, 1), (2, 5, 10)], "sid long, size long, n long")
    src = spark.createDataFrame([("a", 1, 71, 5500, 3.0, 2000.0), ("b", 2, 10, 50, 1.0, 100.0)],
                                "source string, sid long, n_docs long, source_size long, weight double, target double")
    got = {r["sid"]: r for r in mixing.multipliers(hist, src).collect()}
    lam, mean = got[1]["lam"], got[1]["mean"]
    assert sum(n * s * min(2, math.exp(lam * s / mean)) for s, n in ((10, 50), (100, 20), (3000, 1))) == pytest.approx(2000, rel=1e-3)
    assert got[2]["lam"] is None


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).collect() == []
