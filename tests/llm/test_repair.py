import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest

from trawl.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, edit string, block long"
LEGAL = re.compile(r"(s?(ua)+)?")


def conversations():
    r, rows = random.Random(2), []
    texts = ["Fine.", "Cut", "", " \t ", "Why?", "Same.", "Same.", "ends . ", "é!"]
    for c in range(70):
        for t in range(r.randint(1, 9)):
            rows.append((c, t * r.choice([1, 1, 2]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), r.choice(texts) + r.choice(["", "", str(t) + "."])))
    for t in range(120):  # a long one, over several blocks
        rows.append((500, t, ("user", "assistant", "system")[(t * t) % 3], f"text {t % 50}" + (".", "")[t % 7 == 0]))
    rows += [(None, 0, "user", "a."), (None, None, "assistant", None), (None, None, "assistant", None), (600, None, "user", "x."), (600, None, "assistant", "y.")]
    rows += [(601, i, "tool", f"z{i}.") for i in range(5)] + [(602, 5, "user", "q. " + "long " * 30_000 + ".")]
    return rows


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Forward over the rows: of every state the least (cost, edits), with the lines made."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for s, (c, e, o) in list(best.items()):
                for x in "ua":
                    if (s, x) in step and (step[s, x] not in best or (c + 3, e + "I") < best[step[s, x]][:2]):
                        best[step[s, x]] = (c + 3, e + "I", o + [names[x] + ":"])
        return best

    best = {"": (0, "", [])}
    for (_, role, text), f in zip(rows, found):
        new = {}
        for s, (c, e, o) in inserted(best).items():
            options = [(c + 4, e + "D", o, s)]
            if f not in ("b", "d"):
                c += 3 * (f == "t")
                if (s, role[:1]) in step:
                    options.append((c, e + "K", o + [f"{role}:{text}"], step[s, role[:1]]))
                options += [(c + 3, e + "R", o + [f"{names[x]}:{text}"], step[s, x]) for x in "ua" if (s, x) in step]
            for c2, e2, o2, s2 in options:
                if s2 not in new or (c2, e2) < new[s2][:2]:
                    new[s2] = (c2, e2, o2)
        best = new
    return min((v for s, v in inserted(best).items() if s in ("", "a")), key=lambda v: v[:2])


def brute(rows):
    groups, out = defaultdict(list), {}
    for c, t, role, text in rows:
        groups[c].append((t, " " if role is None else role, " " if text is None else text))
    for c, g in groups.items():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        f, turns = faults(g), [t for t, _, _ in g if t is not None]
        cost, audit, lines = cheapest(g, f)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(g))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("b"), f.count("d"), f.count("t"), illegal, cost, audit, "\n".join(lines))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block", [1024, 3])
def test_repair_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "LEAST_BLOCK", block)
    rows = conversations()
    edited, counts = repair.repair(frame(spark, rows))
    want = brute(rows)
    assert {r["conv_id"]: tuple(r)[1:] for r in counts.collect()} == {c: w[:6] for c, w in want.items()}
    got = defaultdict(list)
    for r in edited.collect():
        got[r["conv_id"]].append((r["pos"], r["edit"], r["role"], r["text"]))
    for c, w in want.items():
        rs = sorted(got[c])
        assert "".join(r[1] for r in rs) == w[6]
        stay = [r for r in rs if r[1] != "D"]
        assert "\n".join(f"{r[2]}:{r[3]}" for r in stay) == w[7]
        assert LEGAL.fullmatch("".join(r[2][0] for r in stay))
    told = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in repair.digests(edited).collect()}
    assert told == {c: (w[6], hashlib.sha256(w[7].encode()).hexdigest()) for c, w in want.items()}


def test_checkpoints_agree_with_one_block():
    """Costs and walks through many blocks are those of one."""
    r = random.Random(9)
    for _ in range(50):
        codes = bytes(r.randrange(12) for _ in range(r.randint(1, 40)))
        whole, _ = repair.walk(codes, repair.END, repair.START, True)
        cuts = sorted(r.sample(range(len(codes) + 1), min(3, len(codes))))
        parts = [codes[a:b] for a, b in itertools.pairwise([0, *cuts, len(codes)]) if b > a]
        ends, end = [], repair.END
        for p in reversed(parts):
            ends.append(end)
            table = repair.costs_through(p)
            end = tuple(min(table[4 * s + e] + end[e] for e in range(4)) for s in range(4))
        state, letters = repair.START, ""
        for i, (p, e) in enumerate(zip(parts, reversed(ends))):
            more, state = repair.walk(p, e, state, i == len(parts) - 1)
            letters += more
        assert letters == whole


def test_no_rows(spark):
    edited, counts = repair.repair(frame(spark, []))
    assert edited.collect() == [] and counts.collect() == [] and repair.digests(edited).collect() == []


def test_query_returns_every_conversation(spark, tmp_path):
    import zlib
    rows = conversations()
    frame(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op12_checkpointed_repair(spark, str(tmp_path)).collect()}
    damaged = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
        damaged += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
    want = brute(damaged)
    assert set(got) == {r[0] for r in rows} and Counter(r[0] for r in damaged).keys() == want.keys()
    for c, r in got.items():
        w = want.get(c, (0, 0, 0, 0, 0, 0, "", ""))
        assert tuple(r)[1:] == (*w[:7], hashlib.sha256(w[7].encode()).hexdigest())
