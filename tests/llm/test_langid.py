import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from trawl.llm import langid


def numeric_gradient(weights, key, at, loss):
    eps, old = 1e-3, weights[key][at]
    weights[key][at] = old + eps
    up = loss()
    weights[key][at] = old - eps
    down = loss()
    weights[key][at] = old
    return (up - down) / (2 * eps)


def test_backpropagation_matches_numeric_gradients():
    rng = np.random.default_rng(0)
    by, lens = rng.integers(0, 256, (6, 3)), np.array([6, 4, 2])
    valid = np.arange(6)[:, None] < lens[None]
    w = {k: v.astype(np.float64) for k, v in langid.new_weights(2, 3, 1).items()}
    target = rng.normal(size=(6, 3, 3))

    def loss():
        s, _ = langid._direction(w["xf"], w["uf"], by, valid)
        return float((s * target).sum())

    _, keep = langid._direction(w["xf"], w["uf"], by, valid)
    dx, du = langid._direction_back(w["xf"], w["uf"], by, valid, keep, target)
    for at in [(0, 0), (4, 1), (8, 2)]:
        assert abs(du[at] - numeric_gradient(w, "uf", at, loss)) < 1e-2
    for row in (0, 5, 7):
        assert abs(dx[row, by[0, 0]] - numeric_gradient(w, "xf", (row, by[0, 0]), loss)) < 1e-2


def test_fast_inference_equals_the_training_network():
    w = langid.new_weights(3, 5, 2)
    raws = [bytes(np.random.default_rng(i).integers(0, 256, n).tolist()) for i, n in enumerate((1, 128, 300, 0, 77))]
    sums, won, sizes = langid.Labeller(w).pooled(raws)
    for raw, s, n in zip(raws, sums, won, strict=True):
        total = np.zeros(3)
        step = langid.WINDOW - 2 * langid.MARGIN
        for i in range(0, len(raw), step):  # each with its margins, which are not counted
            lo = max(0, i - langid.MARGIN)
            by = np.frombuffer(raw[lo: i + step + langid.MARGIN], np.uint8).astype(np.intp)[:, None]
            valid = np.ones_like(by, bool)
            f = langid._direction(w["xf"], w["uf"], by, valid)[0]
            b = langid._direction(w["xb"], w["ub"], by[::-1], valid)[0][::-1]
            z = np.einsum("kh,lhb->lkb", w["out"], np.concatenate([f, b], axis=1)) + w["bias"]
            p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
            total += p[i - lo: i - lo + step].sum(axis=(0, 2))
        assert np.allclose(total, s, atol=1e-3) and n.sum() == len(raw)


def test_held_out_accuracy_and_edge_cases(spark, docs, no_docs):
    rows = [(i, prose(i, 60, la), la) for i, la in enumerate(("en", "fr", "de") * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, w = langid.fit(df.where("doc_id < 120"), F.col("text"), F.col("lang"), F.col("doc_id"), steps=150)
    assert names == ["de", "en", "fr"]
    got = langid.identify(df.where("doc_id >= 120"), names, w).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 58
    assert all(0 <= r["score"] <= 1 for r in got)
    edge = langid.identify(docs.withColumn("score", F.lit("mine")), names, w)
    assert edge.columns == [*docs.columns, "lang_pred", "score", "agree"]
    edge = edge.collect()
    assert len(edge) == docs.count()
    for r in edge:
        if r["doc_id"] in (100, 101, 102, 103):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] in (104, 107, 90, 91):
            assert r["lang_pred"] in names
    odd = df.sparkSession.createDataFrame([(1, "\u00b2 \u00bd \u2167 12_34"), (2, "\u00e9")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in langid.identify(odd, names, w).collect()} == {1: True, 2: False}
    assert langid.identify(no_docs, names, w).collect() == []
    assert langid.fit(no_docs, F.col("text"), F.col("lang"), F.col("doc_id")) == ([], None)
    assert {r["lang_pred"] for r in langid.identify(docs, [], None).collect()} == {"und"}


def test_more_than_64_labels(spark):
    letters = [chr(c) for c in range(0x400, 0x2000) if chr(c).isalpha()]

    def words(label, seed):  # letters of its own
        r = random.Random(f"{label} {seed}")
        return " ".join("".join(letters[12 * label + r.randrange(12)] for _ in range(r.randint(2, 7))) for _ in range(30))

    rows = [(1000 * k + i, words(k, i), f"l{k:02}") for k in range(70) for i in range(18 + k // 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, w = langid.fit(df, F.col("text"), F.col("lang"), F.col("doc_id"))
    assert names == [f"l{k:02}" for k in range(70)]
    asked = spark.createDataFrame([(k, words(k, 99), f"l{k:02}") for k in range(70)], df.schema)
    got = langid.identify(asked, names, w).collect()
    right = {r["lang"] for r in got if r["lang"] == r["lang_pred"]}
    assert len(right) >= 66 and len({f"l{k:02}" for k in range(6)} - right) <= 1  # the rarest six were left out
