import re

import pytest

from tests.llm.conftest import prose
from trawl.llm import linededup

COLS = "doc_id long, text string, h string, _deleted string"


def brute(rows, min_words, hashes):
    """Deleted (row, line) pairs by comparing all windows of lines as text."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, hashes[i]))
    seen, gone = {}, set()
    for place, i in enumerate(order):
        lines = [(k, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for k, x in enumerate((rows[i][1] or "").split("\n"))] if rows[i][1] is not None else []
        lines = [x for x in lines if x[2]]
        spans = set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += lines[b][2]
                if n >= min_words:
                    spans.add((a, b))
                    break
            n = 0
            for c in range(a, -1, -1):
                n += lines[c][2]
                if n >= min_words:
                    spans.add((c, a))
                    break
        for a, b in sorted(spans):
            text = tuple(x[1] for x in lines[a: b + 1])
            doc = (rows[i][0], hashes[i])
            first = seen.setdefault(text, (doc, a))
            if first != (doc, a):
                gone.update((i, lines[k][0]) for k in range(a, b + 1))
    out = []
    for i, (d, t, *_rest) in enumerate(rows):
        if t is None:
            out.append((d, None, 0))
            continue
        lines = t.split("\n")
        left = "\n".join(x for k, x in enumerate(lines) if (i, k) not in gone)
        n = sum((i, k) in gone for k in range(len(lines)))
        out.append((d, left if n == 0 or re.search(r"[^\x20\x09-\x0D]", left) else "", n))
    return sorted(out, key=str)


def case():
    p = prose(1, 60)
    run = "\n".join(prose(10 + i, 12) for i in range(6))
    rows = [(1, f"{prose(2, 8)}\n{p}\n{prose(3, 9)}"), (2, f"{prose(4, 30)}\n\n{p}"), (3, f"{prose(5, 5)}\n{run}\n{prose(6, 7)}"),
            (4, f"{run}\n{prose(7, 3)}\n{run}"), (5, p), (6, "same line\n" * 60), (7, "same line\nother\n" * 5), (8, None), (9, ""),
            (10, "\n \n\t"), (None, p), (11, f"{prose(2, 8)}\nshort\n{prose(3, 9)}"), (12, "\n".join(prose(20 + i % 40, 4) for i in range(300))),
            (13, prose(9, 40_000)), (2, f"{prose(4, 30)}\n\n{p}"), (14, "\n".join(run.split("\n")[1:5]))]
    return [(d, t, "x", "y") for d, t in rows]


@pytest.mark.parametrize("min_words", [50, 10, 1])
def test_matches_brute_force(spark, min_words):
    df = spark.createDataFrame(case(), COLS).repartition(3)
    rows = df.selectExpr("doc_id", "text", "xxhash64(text) as hh").collect()
    got = linededup.dedup(df, min_words=min_words)
    assert got.columns == ["doc_id", "text", "h", "_deleted"]
    result = sorted(((r["doc_id"], r["text"], r["_deleted"]) for r in got.collect()), key=str)
    assert result == brute([(r[0], r[1]) for r in rows], min_words, [r[2] for r in rows])


def test_no_python_in_the_plan(spark):
    plan = linededup.dedup(spark.createDataFrame(case(), COLS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(spark):
    assert linededup.dedup(spark.createDataFrame([], COLS)).collect() == []
