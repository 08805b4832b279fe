import itertools
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trawl.llm import urlrules as U

SCHEMA = "page_id long, url string, _row string, tokens long, _rule string, host string"


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "clash", 7, "clash", "clash") for i, u in urls], SCHEMA).repartition(3)


def urls():
    out, langs = [], ("en", "fr", "es", "de")
    for i in range(240):
        tld, lang = ("com", "net", "org")[i % 3], langs[(i // 3) % 4]
        out.append((i, f"http{'s' if i % 5 else ''}://{'casino-' if i % 7 == 0 else ''}h{i % 4}.example.{tld}/{lang}/{i}{'.html' if i % 2 else '?page=2&ref=x'}"))
    out += [(240, None), (241, ""), (242, "no scheme"), (243, "http://"), (244, "x://COM"), (245, "x://a.COM/"), (246, "http://www.example.com/en/x"),
            (247, "http://sub.www.example.com/en/"), (248, "http://notexample.com/en/"), (249, "http://net/fr"), (250, "http://net/fr/"),
            (251, "http://user@a.net:80/es/"), (252, "http://x.org/" + "long-segment/" * 20_000), (None, "http://x.net/es/"), (1, out[1][1]), (1, out[1][1])]
    return out


def listed(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def mined(rows, least, sure, most):
    """Every combination of the chosen tokens counted: {antecedent: {verdict: n}}."""
    n, b = len(rows), sum(v == "block" for _, v in rows)
    df, blocked = Counter(t for ts, _ in rows for t in ts), Counter(t for ts, v in rows for t in ts if v == "block")
    sets, label = Counter(), Counter()
    for ts, v in rows:
        best = sorted((-abs(blocked[t] * n - df[t] * b), t) for t in ts if df[t] >= least)[:most]
        for size in range(1, len(best) + 1):
            for c in itertools.combinations(sorted(t for _, t in best), size):
                sets[c] += 1
                label[c, v] += 1
    return {(c, v): (k / sets[c], k) for (c, v), k in label.items() if k >= least and k / sets[c] >= sure}


@pytest.fixture(scope="module")
def judged(spark):
    return U.judge(frame(spark, urls())).collect()


def test_listed_rules(judged):
    assert len(judged) == len(urls())
    want = Counter((i, *listed(u)[:2], listed(u)[2][0]) for i, u in urls())
    assert Counter((r["page_id"], r["_host"], r["_path"], r["_rule"]) for r in judged if r["page_id"] != 1) == \
        Counter({k: v for k, v in want.items() if k[0] != 1})
    assert all(r["_verdict"] == listed(r["url"])[2][1] for r in judged if r["_rule"])
    assert all(r["_verdict"] == "allow" and not r["_host"] for r in judged if r["page_id"] in (240, 241, 242, 243))


def test_mined_rules_match_all_combinations(spark, judged):
    u = F.col("url")
    toks = {r["url"]: r["t"] for r in frame(spark, urls()).select("url", U.tokens(u, U.host(u), U.path(u)).alias("t")).collect()}
    rules = mined([(toks[u], listed(u)[2][1]) for _, u in urls() if listed(u)[2][1]], 5, 0.9, 8)
    assert rules
    kinds = defaultdict(int)
    for r in judged:
        if r["_rule"] is None:
            fits = [(-c, -k, v == "allow", len(a), a, v) for (a, v), (c, k) in rules.items() if set(a) <= set(toks[r["url"]])]
            want = min(fits)[-1] if fits else "allow"
            assert r["_verdict"] == want
            kinds[want, bool(fits)] += 1
    assert kinds["block", True] and kinds["allow", False]


def test_needless_rules_are_pruned(spark):
    rows = spark.createDataFrame([(i, ["h:a", "h:b"] if i % 2 else ["h:a", "h:c"], "block") for i in range(20)]
                                 + [(100 + i, ["h:z"], "allow") for i in range(20)], "_row long, tokens array<string>, verdict string")
    from trawl.llm.common import Scratch
    got = {tuple(r["antecedent"]): r["verdict"] for r in U.mine(rows, Scratch(spark)).collect()}
    assert got == {("h:a",): "block", ("h:b",): "block", ("h:c",): "block", ("h:z",): "allow"}


def test_no_rows_and_no_labels(spark):
    assert U.judge(frame(spark, [])).collect() == []
    none = U.judge(frame(spark, [(1, "http://x.org/a"), (2, None)])).collect()
    assert [r["_verdict"] for r in none] == ["allow", "allow"] and all(r["_row"] == "clash" for r in none)


def test_no_python_worker(spark, capsys):
    U.judge(frame(spark, urls())).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
