"""No frequent token of a URL is left out of the mining."""

from trawl.llm import urlrules as U
from trawl.llm.common import Scratch


def rules_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "_row long, tokens array<string>, verdict string").repartition(3)
    return U.mine(df, Scratch(spark), **options).collect()


def test_a_rule_of_the_tokens_least_apart(spark):
    """Ten tokens each: eight whose labels differ much from the average, and two that say something together only."""
    rows = []
    for i in range(400):
        block = i % 2
        a, b = (i // 2) % 2, ((i // 2) % 2) if block else 1 - (i // 2) % 2  # a = b: block
        loud = [f"p:loud{k}" for k in range(8) if (i // 4 + k) % 11 or block]
        rows.append((i, sorted([f"q:a{a}", f"q:b{b}", *loud]), "block" if block else "allow"))
    got = {(tuple(r["antecedent"]), r["verdict"]) for r in rules_of(spark, rows)}
    assert {(("q:a0", "q:b0"), "block"), (("q:a1", "q:b1"), "block"), (("q:a0", "q:b1"), "allow"), (("q:a1", "q:b0"), "allow")} <= got


def test_tokens_of_the_same_urls_are_one_item_but_match_each_for_itself(spark):
    words = [f"p:w{k:02d}" for k in range(40)]  # 2^40 combinations, one item
    rows = [(i, sorted([*words, "h:net" if i % 2 else "h:com"]), "block" if i % 2 else "allow") for i in range(60)]
    rows += [(100 + i, sorted([*words, "q:x"]), "block") for i in range(600)]
    found = rules_of(spark, rows + [(900 + i, ["h:com"], "block") for i in range(30)])
    posts = {r["post"] for r in found if r["antecedent"] == ["p:w00"]}
    assert posts == set(words) and all(len(r["antecedent"]) == 1 for r in found if r["verdict"] == "block")
    mined = spark.createDataFrame(found)
    rows = spark.createDataFrame([(1, ["p:w17"]), (2, ["q:x"]), (3, ["p:other"])], "_row long, tokens array<string>")
    best = {r["_row"]: r["best"]["verdict"] for r in U.match(rows, mined).collect()}
    assert best == {1: "block", 2: "block"}
