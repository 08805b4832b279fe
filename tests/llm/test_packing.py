import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from trawl.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_cuts_fill_their_slots():
    for n in range(1, 5000):
        pieces = packing.cuts(n, 2048, 64, 0.97)
        assert sum(x for x, _ in pieces) == n
        assert all(k * x <= 2048 for x, k in pieces if k)
        assert all(x < 32 for x, k in pieces if k == 0)


def test_every_id_lies_in_one_piece(docs):
    tok = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]].append([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    rows = packing.pack(docs, PATH).collect()
    got, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(got) == set(want)
    for doc, texts in want.items():
        pieces = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got[doc])
        expect = []
        for ids in texts:
            a, at = np.asarray(ids, "<u4"), 0
            for n, _ in packing.cuts(len(ids), 2048, 64, 0.97):
                expect.append((at, n, zlib.crc32(a[at: at + n].tobytes()), len(ids)))
                at += n
        assert pieces == sorted(expect)
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len(bins)) > 0.9


def test_special_tokens_as_the_library_gives_them(spark, no_docs):
    encode, tok, r = packing.load_encoder(PATH), Tokenizer.from_file(PATH), random.Random(4)
    assert encode("a <|endoftext|> b") == [64, 220, 50256, 275]
    bits = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "a", "\n", "é", "'s", "12", "<|ENDOFTEXT|>", "\u00a0"]
    for _ in range(2000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 9)))
        assert encode(text) == tok.encode(text, add_special_tokens=False).ids, text
    docs = spark.createDataFrame([(1, "x <|endoftext|><|endoftext|>y"), (2, "<|endoftext|>")], "doc_id long, text string")
    for row in packing.pack(docs, PATH).collect():
        ids = [*tok.encode("x <|endoftext|><|endoftext|>y" if row["doc_id"] == 1 else "<|endoftext|>", add_special_tokens=False).ids, 1]
        assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
    assert packing.pack(no_docs, PATH).collect() == []
