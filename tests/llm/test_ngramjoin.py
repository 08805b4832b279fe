import re

import pytest

from trawl.llm import ngramjoin

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, width):
    out = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER))
        out.append(frozenset(tuple(w[i: i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, width, num, den):
    sets = sets_of(rows, width)
    label = {r["doc_id"]: r["doc_id"] for r in rows}
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if None in (rows[i]["doc_id"], rows[j]["doc_id"]) or not sets[i]:
                continue
            inter = len(sets[i] & sets[j])
            if inter and den * inter >= num * (len(sets[i]) + len(sets[j]) - inter):
                links.append((rows[i]["doc_id"], rows[j]["doc_id"]))
    for _ in range(len(rows)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return sorted(((r["doc_id"], len(s), label[r["doc_id"]]) for r, s in zip(rows, sets, strict=True)), key=str)


@pytest.mark.parametrize("width,num,hot,rounds", [(3, 90, 16, 5), (3, 90, 1, 5), (5, 80, 2, 1), (3, 90, 1, 0)])
def test_components_match_brute_force(docs, monkeypatch, width, num, hot, rounds):
    """Cold buckets, hot buckets with pivots, and the buckets left after the rounds."""
    monkeypatch.setattr(ngramjoin, "HOT", hot)
    monkeypatch.setattr(ngramjoin, "ROUNDS", rounds)
    monkeypatch.setattr(ngramjoin, "BLOCK", 4)
    small = docs.where("length(text) < 20000 or text is null")
    got = sorted((tuple(r) for r in ngramjoin.similar_components(small, width=width, num=num).collect()), key=str)
    assert got == brute(small.collect(), width, num, 100)


def test_empty_table_and_low_threshold(no_docs):
    assert ngramjoin.similar_components(no_docs).collect() == []
    with pytest.raises(ValueError):
        ngramjoin.similar_components(no_docs, num=70)


def test_the_sketch_is_added_up_in_tasks(docs, no_docs):
    """The levels are those of all sets; of the sums, eight bytes a cell, the driver holds none."""
    import tracemalloc

    import numpy as np

    rows = ngramjoin.texts(docs, "doc_id", "text")
    tracemalloc.start()
    got = ngramjoin.frequency_levels(rows, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    hasher, cells = ngramjoin.WordHasher(), np.zeros(ngramjoin.CELLS, np.int64)
    for r in rows.collect():
        np.add.at(cells, (ngramjoin.shingles((r["text"] or "").encode(), 3, hasher) & np.uint64(ngramjoin.CELLS - 1)).astype(np.int64), 1)
    usual = max(1.0, float(np.median(cells)))
    assert (got == np.clip(np.ceil(2 * np.log2(np.maximum(cells / usual, 1.0))), 0, 255)).all() and got.max() > 0
    assert peak < 5 * ngramjoin.CELLS
    assert not ngramjoin.frequency_levels(ngramjoin.texts(no_docs, "doc_id", "text"), 3).any()


def test_the_sketch_goes_by_the_usual_count(spark, monkeypatch):
    """Where most cells are in use, levels are relative to the median."""
    import numpy as np

    monkeypatch.setattr(ngramjoin, "CELLS", 1 << 10)
    rows = spark.createDataFrame([(i, " ".join(f"w{i * 7 + j * j}" for j in range(90)) + " the same few words") for i in range(200)], "doc long, text string")
    cells, hasher = np.zeros(1 << 10, np.int64), ngramjoin.WordHasher()
    for r in rows.collect():
        cells += np.bincount((ngramjoin.shingles(r["text"].encode(), 3, hasher) & np.uint64((1 << 10) - 1)).astype(np.int64), minlength=1 << 10)
    usual = float(np.median(cells))
    assert usual > 1
    assert (ngramjoin.frequency_levels(rows, 3) == np.clip(np.ceil(2 * np.log2(np.maximum(cells / usual, 1.0))), 0, 255)).all()
