import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, key string, rep long"


def prose(seed: int, words: int, lang: str = "en") -> str:
    parts = {"en": "th on er ing ed and tion wh st re".split(), "fr": "é eau oi ment ère que aux le ç ai".split(),
             "de": "sch ung ß ü ver ge keit ä te en".split()}[lang]
    r = random.Random(seed)
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(words))


def corpus():
    """Copies, near copies, empties, nulls, ties, one very long text, repeated rows."""
    rows, rnd = [], random.Random(5)
    for i in range(60):
        lang = ("en", "fr", "de")[i % 3]
        rows.append((i, prose(i, rnd.randint(30, 200), lang), lang, f"s{i % 4}"))
    base = prose(1000, 300).split()
    for i in range(60, 90):  # near copies of one text: i - 60 words changed
        w = list(base)
        for j in range(i - 60):
            w[(j * 37) % 300] = f"changed{i}x{j}"
        rows.append((i, " ".join(w), "en", "s0"))
    rows += [(90 + k, rows[3][1], "en", "s1") for k in range(5)]                       # copies
    rows += [(100, None, "en", "s1"), (101, "", None, None), (102, " \n\t ", "fr", "s2"), (103, "1234 5678 !!", None, "s9"),
             (104, prose(7, 30_000), "en", "s0"), (105, "one two", "en", None), (106, "ONE Two", "en", None),
             (107, "é" * 50_000, "fr", None), (None, rows[3][1], "fr", "s3"), (None, None, None, None)]
    rows += [rows[0], rows[0]]                                                         # repeated rows
    return [(d, t, la, s, None if t is None else len(t), "clash", "k", -1) for d, t, la, s in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
