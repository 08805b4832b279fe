"""The identified language has an effect on what follows: sequences are of one language."""

import corpus_pipeline as P
from tests.llm.conftest import prose


def test_sequences_are_of_one_identified_language(spark):
    rows = [(i, prose(i, 40, ("en", "fr", "de")[i % 3]), ("en", "fr", "de")[i % 3] if i % 10 else None, "s", 1) for i in range(240)]
    rows += [(900, prose(900, 60, "fr"), "en", "s", 1)]  # a wrong label
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()
    told = P.written(P.language(spark, docs, None), "test")
    lang = {r["doc_id"]: r["lang"] for r in told.collect()}
    assert sum(lang[i] == ("en", "fr", "de")[i % 3] for i in range(240)) >= 235 and lang[900] == "fr"
    packed = P.pack_sequences(spark, told, None).collect()
    assert {r["doc_id"] for r in packed} == set(lang) and len(lang) == 241
    held, used = {}, {}
    for r in packed:
        held.setdefault(r["sequence_id"], set()).add(lang[r["doc_id"]])
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert all(len(x) == 1 for x in held.values()) and len({x for s in held.values() for x in s}) == 3
    assert max(used.values()) <= 2048


def test_groups_share_no_sequence_and_null_is_one(spark):
    from trawl.llm import packing
    rows = [(i, prose(i, 5), (None, "a", "b")[i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, g string").coalesce(1).cache()
    of = {r["doc_id"]: r["g"] for r in df.collect()}
    seqs = {}
    for r in packing.pack(df, P.tokenizer_path(), group_col="g").collect():
        seqs.setdefault(r["sequence_id"], set()).add(of[r["doc_id"]])
    assert {x for s in seqs.values() for x in s} == {None, "a", "b"} and all(len(s) == 1 for s in seqs.values())
