"""Operator 3, n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles (64-bit hashes). All sets are
sorted by one order, rare shingles first: a fixed-size sketch of document
frequencies gives each hash a level, ties go by the hash. Two sets with
Jaccard >= t share at least l shingles among their first
``|s| - ceil(t |s|) + l``; l = 1 is the usual prefix filter. Each document
chooses its l by estimated cost: a longer prefix is scanned, but partners must
share more of it. A pair is a candidate when it shares at least the smaller of
both l's, and is then verified on the whole sets.

Candidates are tried on signatures first: a bitmap of eight bits per shingle,
whose common bits, with the shingles that share a bit, bound the overlap from
above. Only pairs that the bound allows have their whole sets compared.

Shingles met in the prefixes of more than ``HOT`` documents would emit the
square of that number. They are handled in rounds instead: every hot bucket
names a pivot, its members are compared with it, and those with Jaccard >= 1/2
form a cluster, in which each is described by its difference from the pivot.
Those >= 1/2 + (1 - t) leave the bucket. As the Jaccard distance is a metric,
two linked members (distance <= 1 - t) of a bucket always meet in a cluster: when
the first of them leaves for a pivot, the other is within 1/2 of that pivot.
Clusters are compared inside tasks, block against block, and return only a
spanning forest of their links. What is left of a bucket after the rounds is of
many small kinds: its members' signatures are compared block against block, and what
the bound allows is verified like any candidate.

Equal sets are one class before all of this. Whole sets are never stored for
all documents, only hashed anew for those with a candidate.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Scratch, bucketed, components, written

MAX_L = 4
HOT = 16
VERIFY = 24.0      # cost of a verification in units of a scanned posting
ROUNDS = 3
CELLS = 1 << 22    # counters of the frequency sketch
SIGNATURE = 8      # bits a shingle
WANTED = 1 << 26   # bits of the filter of wanted documents
BLOCK = 64         # cluster members in a block, as long as that gives at most GRID blocks
GRID = 40
WIDEST = 1024
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# Word hashes are polynomials over random byte values, modulo 2**64, so all words of
# a text come from one running sum.
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(0, 1 << 62)) * 4 + 3
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
CHUNK = 1 << 20  # bytes hashed at once, give or take a word


class WordHasher:
    """Hashes of the words of texts in UTF-8, A-Z lower-cased."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.power) < n:
            k = len(self.power)
            self.power = np.concatenate([self.power, self.power * np.uint64(pow(_BASE, k, 1 << 64))])
            self.inverse = np.concatenate([self.inverse, self.inverse * np.uint64(pow(pow(_BASE, -1, 1 << 64), k, 1 << 64))])

    def _chunk(self, a: np.ndarray) -> np.ndarray:
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[a], [True]])))
        start, end = edge[::2], edge[1::2]
        self._grow(len(a) + 1)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[a] * self.power[: len(a)])])
        h = (run[end] - run[start]) * self.inverse[start] + (end - start).astype(np.uint64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def words(self, raw: bytes) -> np.ndarray:
        a = np.frombuffer(raw.translate(_LOWER), np.uint8)
        if len(a) <= CHUNK:
            return self._chunk(a)
        out, at = [], 0
        while at < len(a):  # cut behind the last blank of a chunk, or at the next one
            stop = min(at + CHUNK, len(a))
            if stop < len(a):
                blank = np.flatnonzero(_SPACE[a[at:stop]])
                while not len(blank) and stop < len(a):
                    stop = min(stop + CHUNK, len(a))
                    blank = np.flatnonzero(_SPACE[a[at:stop]])
                stop = at + int(blank[-1]) + 1 if len(blank) else len(a)
            out.append(self._chunk(a[at:stop]))
            at = stop
        return np.concatenate(out)


def shingles(raw: bytes, width: int, hasher: WordHasher) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text in
    UTF-8; with fewer words, of the whole sequence."""
    h = hasher.words(raw)
    n = len(h)
    if n == 0:
        return h
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=n)], np.uint64)
    acc = np.zeros(n - width + 1, np.uint64)
    for i in range(width):  # a mixing round for each word, then a final one
        acc ^= h[i: n - width + 1 + i]
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    acc *= np.uint64(0xBF58476D1CE4E5B9)
    acc ^= acc >> np.uint64(32)
    acc.sort()
    return acc[np.concatenate([[True], acc[1:] != acc[:-1]])]


def least(n: int, num: int, den: int) -> int:
    """ceil(n * num / den): the least overlap of a linked partner."""
    return -(-n * num // den)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))


def frequency_levels(rows: DataFrame, width: int) -> np.ndarray:
    """(CELLS,) uint8: the binary logarithm of how many sets hold a hash of the cell.

    Every task counts its own sets; arrays of fixed size are added up in parts by key, and the
    levels of a part are made where its sums are. The driver gets the usual count and the
    levels, a byte a cell. (A task counts to 255 for each cell: beyond that a shingle is frequent anyway.)"""
    spark, cells_n, parts = rows.sparkSession, CELLS, 64
    size = cells_n // parts

    def count(batches):
        cells, hasher, held, n = np.zeros(cells_n, np.int64), WordHasher(), [], 0
        for b in batches:
            for t in b.column(1):
                held.append(shingles((t.as_py() or "").encode("utf-8", "replace"), width, hasher) & np.uint64(cells_n - 1))
                n += len(held[-1])
                if n > cells_n // 2:
                    cells += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells_n)
                    held, n = [], 0
        if held:
            cells += np.bincount(np.concatenate(held).astype(np.int64), minlength=cells_n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(parts), pa.int32()), pa.array([np.minimum(cells[i * size: (i + 1) * size], 255).astype(np.uint8).tobytes() for i in range(parts)], pa.binary())],
            ["part", "cells"])

    def values(batches):
        for b in batches:
            for x in b.column(1):
                v, k = np.unique(np.frombuffer(x.as_py(), np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(k, pa.int64())], ["v", "k"])

    def level(batches):
        for b in batches:
            sums = [np.frombuffer(x.as_py(), np.int64) for x in b.column(1)]
            levels = [np.clip(np.ceil(2 * np.log2(np.maximum(x / usual, 1.0))), 0, 255).astype(np.uint8).tobytes() for x in sums]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(levels, pa.binary())], ["part", "levels"])

    temp, out = Scratch(spark), np.zeros(cells_n, np.uint8)
    counted = temp.written(rows.mapInArrow(count, "part int, cells binary"), "sets-sketch")
    added = (counted.rdd.map(lambda r: (r["part"], np.frombuffer(r["cells"], np.uint8).astype(np.int64)))
             .reduceByKey(lambda a, b: a + b, parts).map(lambda r: (r[0], r[1].tobytes())))
    summed = temp.written(spark.createDataFrame(added, "part int, cells binary"), "sets-sums")
    held = summed.mapInArrow(values, "v long, k long").groupBy("v").agg(F.sum("k").alias("k"))
    usual = max(1.0, held.agg(F.percentile("v", 0.5, F.col("k"))).first()[0] or 0.0)  # of no rows: null
    for r in summed.mapInArrow(level, "part int, levels binary").collect():
        out[r["part"] * size: (r["part"] + 1) * size] = np.frombuffer(r["levels"], np.uint8)
    temp.drop()
    return out


def prefixes(rows: DataFrame, levels, width: int, num: int, den: int) -> DataFrame:
    """(doc, n, set_id, prefix): set size, digest of the set and its longest prefix, of every row."""
    def run(batches):
        level, hasher = levels.value, WordHasher()
        for b in batches:
            ns, digests, firsts = [], [], []
            for t in b.column(1):
                s = shingles((t.as_py() or "").encode("utf-8", "replace"), width, hasher)
                n = len(s)
                k = min(n, n - least(n, num, den) + MAX_L)
                lv = level[(s & np.uint64(CELLS - 1)).astype(np.int64)]
                first = s[np.argsort(lv, kind="stable")[:k]]  # s is sorted: ties go by the hash
                ns.append(n)
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                firsts.append(first.view(np.int64))
            off = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
            flat = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))],
                ["doc", "n", "set_id", "prefix"])

    return rows.mapInArrow(run, "doc long, n long, set_id binary, prefix array<long>")


def signature(s: np.ndarray) -> np.ndarray:
    """Bitmap of a set in 64-bit words; its size in bits is a power of two."""
    bits = max(64, 1 << int(SIGNATURE * len(s) - 1).bit_length()) if len(s) else 64
    at = (s & np.uint64(bits - 1)).astype(np.int64)
    out = np.zeros(bits, np.uint8)
    out[at] = 1
    return np.packbits(out, bitorder="little").view("<u8")


def fold(sig: np.ndarray, words: int) -> np.ndarray:
    """The signatures (rows) as they are with fewer bits."""
    while sig.shape[1] > words:
        half = sig.shape[1] // 2
        sig = sig[:, :half] | sig[:, half:]
    return sig


def most_common(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Upper bounds of all overlaps of two lists of sets, from their signatures (rows, of one width each) and sizes."""
    words = min(a.shape[1], b.shape[1])
    a, b = fold(a, words), fold(b, words)
    double = np.minimum((na - np.bitwise_count(a).sum(axis=1))[:, None], (nb - np.bitwise_count(b).sum(axis=1))[None])
    both = np.zeros((len(a), len(b)), np.int64)
    for w in range(words):
        both += np.bitwise_count(a[:, w][:, None] & b[:, w][None])
    return np.minimum(both + double, np.minimum(na[:, None], nb[None]))


def wanted_bits(ids: DataFrame) -> np.ndarray:
    """Bitmap of the hashes of ``ids`` (rep): at most WANTED / 64 rows reach the driver."""
    cell = F.pmod(F.xxhash64("rep"), F.lit(WANTED))
    words = (ids.select(cell.alias("c")).groupBy(F.floor(F.col("c") / 64).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(c % 64 as int))")).alias("bits")).toArrow())
    out = np.zeros(WANTED // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def whole_sets(rows: DataFrame, bits, width: int) -> DataFrame:
    """(rep, n, sig, tokens): size, signature and sorted set, as bytes, of the wanted rows.

    A text is hashed where it is read if its id is among ``bits``, so no text is shuffled. The
    bitmap lets through a few others, which no pair names; the more ids there are, the more of them."""
    def run(batches):
        hasher, known = WordHasher(), bits.value
        for b in batches:
            cell = b.column(2).to_numpy()
            hit = np.flatnonzero((known[cell // 64] >> (cell % 64).astype(np.uint64)) & np.uint64(1))
            b = b.take(pa.array(hit))
            sets = [shingles((t.as_py() or "").encode("utf-8", "replace"), width, hasher) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "n", "sig", "tokens"])

    cells = rows.where("doc is not null").withColumn("cell", F.pmod(F.xxhash64("doc"), F.lit(WANTED)))
    return cells.mapInArrow(run, "rep long, n long, sig binary, tokens binary")


def allowed_pairs(batches, num, den):
    """Of (a, b, n and signature of both) the pairs whose bound reaches num / den."""
    for b in batches:
        a_id, b_id, na, sa, nb, sb = (b.column(i).to_pylist() for i in range(6))
        keep = []
        for i in range(len(a_id)):
            x, y = np.frombuffer(sa[i], "<u8")[None], np.frombuffer(sb[i], "<u8")[None]
            most = int(most_common(x, y, np.array([na[i]]), np.array([nb[i]]))[0, 0])
            keep.append(den * most >= num * (na[i] + nb[i] - most))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum()) if len(b) else 0


def linked_pairs(batches, num, den):
    """Of (a, b, tokens of both) the pairs that are linked."""
    for b in batches:
        out_a, out_b = [], []
        for a, c, ta, tc in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tc, np.uint64)
            i = overlap(x, y)
            if den * i >= num * (len(x) + len(y) - i):
                out_a.append(a)
                out_b.append(c)
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


CLUSTER = "pivot long, rep long, base long, plus binary, minus binary, near boolean"


def against_pivot(batches, num, den):
    """(pivot, rep, tokens of both) to cluster rows: what the member has more and less than the pivot.

    Members with Jaccard >= 1/2 join the cluster; those >= 1/2 + (1 - t) are near."""
    for b in batches:
        cols = {k: [] for k in ("pivot", "rep", "base", "plus", "minus", "near")}
        for p, r, tp, tr in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            x, y = np.frombuffer(tp, np.uint64), np.frombuffer(tr, np.uint64)
            i = overlap(x, y)
            union = len(x) + len(y) - i
            if 2 * i < union:
                continue
            for k, v in (("pivot", p), ("rep", r), ("base", len(x)), ("plus", np.setdiff1d(y, x, True).tobytes()),
                         ("minus", np.setdiff1d(x, y, True).tobytes()), ("near", 2 * den * i >= (den + 2 * (den - num)) * union)):
                cols[k].append(v)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), types, strict=True)], list(cols))


def common(rows_a: list[np.ndarray], rows_b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as a matrix product over shared tokens."""
    flat_a, flat_b = (np.concatenate(r) if r else np.zeros(0, np.uint64) for r in (rows_a, rows_b))
    shared = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(rows_a), len(rows_b)), np.float32)
    own_a, own_b = (np.repeat(np.arange(len(r)), [len(x) for x in r]) for r in (rows_a, rows_b))
    for i in range(0, len(shared), 4096):
        some = shared[i: i + 4096]
        sides = []
        for flat, own, n in ((flat_a, own_a, len(rows_a)), (flat_b, own_b, len(rows_b))):
            at = np.minimum(np.searchsorted(some, flat), len(some) - 1)
            hit = some[at] == flat
            m = np.zeros((n, len(some)), np.float32)
            m[own[hit], at[hit]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def cluster_links(num: int, den: int):
    """For groups (cluster, i, j) of member rows: a spanning forest of the links between block i and block j."""
    from trawl.llm.epsjoin import forest

    def run(t: pa.Table) -> pa.Table:
        d = {c: t.column(c).to_pylist() for c in ("rep", "blk", "i", "j", "base", "plus", "minus")}
        i, j = d["i"][0], d["j"][0]
        side = {s: [k for k, x in enumerate(d["blk"]) if x == s] for s in (i, j)}
        ia, ib = side[i], side[j]
        plus = [np.frombuffer(x, np.uint64) for x in d["plus"]]
        minus = [np.frombuffer(x, np.uint64) for x in d["minus"]]
        size = np.array([b + len(p) - len(m) for b, p, m in zip(d["base"], plus, minus, strict=True)], np.int64)
        less = np.array([len(m) for m in minus], np.int64)
        both_less = common([minus[k] for k in ia], [minus[k] for k in ib]).astype(np.int64)
        both_more = common([plus[k] for k in ia], [plus[k] for k in ib]).astype(np.int64)
        base = d["base"][0] if d["base"] else 0
        inter = base - (less[ia][:, None] + less[ib][None] - both_less) + both_more
        link = den * inter >= num * (size[ia][:, None] + size[ib][None] - inter)
        rep = np.array(d["rep"], np.int64)
        r, c = np.nonzero(link)
        keep = rep[ia][r] != rep[ib][c]
        r, c = r[keep], c[keep]
        a, b = [], []
        if len(r):
            lab = forest(r, c, len(ia), len(ib))
            nodes = np.concatenate([rep[ia], rep[ib]])
            hit = np.flatnonzero(lab >= 0)
            a, b = nodes[hit], rep[ib][lab[hit]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def block_pairs(members: DataFrame) -> DataFrame:
    """Rows of ``members`` (cluster, rep, ...) dealt to the pairs of blocks of their cluster:
    blk is a row's own block, (cluster, i, j) its pair."""
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    n = F.when(F.col("k") <= BLOCK * GRID, F.ceil(F.col("k") / BLOCK)).otherwise(F.greatest(F.lit(GRID), F.ceil(F.col("k") / WIDEST)))
    sizes = sizes.withColumn("blocks", n.cast("int"))
    dealt = members.join(sizes, "cluster").withColumn("blk", F.pmod(F.xxhash64("rep", F.lit(11)), F.col("blocks").cast("long")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")).drop("k", "blocks", "other")


def join_clusters(clusters: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) links inside clusters (cluster, rep, base, plus, minus)."""
    return block_pairs(clusters).groupBy("cluster", "i", "j").applyInArrow(cluster_links(num, den), "a long, b long")


def allowed_in_blocks(num: int, den: int):
    """For groups (cluster, i, j) of (rep, n, sig): the pairs between block i and block j whose bound reaches num / den."""
    def run(t: pa.Table) -> pa.Table:
        rep, blk, n = (np.array(t.column(c).to_pylist(), np.int64) for c in ("rep", "blk", "n"))
        sig = [np.frombuffer(x, "<u8") for x in t.column("sig").to_pylist()]
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        width = np.array([len(x) for x in sig])
        a, b = [], []
        for wa in np.unique(width[blk == i]):
            ia = np.flatnonzero((blk == i) & (width == wa))
            for wb in np.unique(width[blk == j]):
                ib = np.flatnonzero((blk == j) & (width == wb))
                most = most_common(np.array([sig[k] for k in ia]), np.array([sig[k] for k in ib]), n[ia], n[ib])
                r, c = np.nonzero((den * most >= num * (n[ia][:, None] + n[ib][None] - most)) & (rep[ia][:, None] != rep[ib][None]))
                a.append(np.minimum(rep[ia][r], rep[ib][c]))
                b.append(np.maximum(rep[ia][r], rep[ib][c]))
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        one = np.unique(np.stack([a, b], axis=1), axis=0)
        return pa.table({"a": pa.array(one[:, 0], pa.int64()), "b": pa.array(one[:, 1], pa.int64())})

    return run


def similar_components(docs: DataFrame, *, width: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row, for Jaccard >= num / den (at least 0.8).

    Documents without words or text have the empty set and link with nothing.
    Rows with the same doc_id are one node. A row without a doc_id links with nothing and has
    no component. Equal sets (repeated rows, copies) are compared once. Other
    columns are not read; an empty table gives an empty result.
    """
    if 10 * num < 8 * den:
        raise ValueError("the clusters' bounds hold for similarities of 0.8 and more")
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    levels = spark.sparkContext.broadcast(frequency_levels(rows, width))  # 4 MB, whatever the input
    temp = Scratch(spark)
    firsts = temp.written(prefixes(rows, levels, width, num, den), "sets-prefixes")
    levels.destroy()
    every = written(firsts.drop("prefix"), "sets")
    classes = temp.written(firsts.where("n > 0 and doc is not null").groupBy("set_id", "n")
                           .agg(F.min("doc").alias("rep"), F.first("prefix").alias("prefix")), "sets-classes")

    post = classes.select("rep", "n", F.posexplode("prefix").alias("pos", "token"))
    counts = post.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = temp.written(post.join(counts, "token"), "sets-shared")
    need = (F.col("n") - F.ceil(F.col("n") * num / den)).cast("int")

    # l of each document by estimated cost, over its cold postings
    cold = shared.where(F.col("c") <= HOT)
    cost = [F.sum(F.when(F.col("pos") < need + l, F.col("c") - 1).otherwise(0)).alias(f"s{l}") for l in range(1, MAX_L + 1)]
    chosen = cold.groupBy("rep", "n").agg(*cost)
    weigh = [F.col(f"s{l}") * (1.0 + VERIFY / l) for l in range(1, MAX_L + 1)]
    best = F.array_position(F.array(*weigh), F.least(*weigh)).cast("int")
    chosen = chosen.select("rep", F.least(best, F.greatest(F.lit(1), F.col("n").cast("int") - need)).alias("l"))
    near = cold.join(chosen, "rep").where(F.col("pos") < need + F.col("l")).select("token", "rep", "n", "l")
    one = near.select("token", *[F.col(c).alias(f"{c}_a") for c in ("rep", "n", "l")])
    two = near.select("token", *[F.col(c).alias(f"{c}_b") for c in ("rep", "n", "l")])
    fits = (den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b"))
    pairs = (one.join(two, "token").where((F.col("rep_a") < F.col("rep_b")) & fits).groupBy("rep_a", "rep_b")
             .agg(F.count(F.lit(1)).alias("m"), F.min(F.least("l_a", "l_b")).alias("l")).where("m >= l"))
    pairs = temp.written(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")), "sets-pairs")

    # a linked pair shares a hot bucket, or enough cold ones to be among the pairs
    hot = temp.written(shared.where((F.col("c") > HOT)).select("token", "rep"), "sets-hot")
    wanted = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))) \
        .unionByName(hot.select("rep")).distinct()
    bits = spark.sparkContext.broadcast(wanted_bits(wanted))  # 8 MB, whatever the input
    sets = bucketed(whole_sets(rows, bits, width), "rep", "sets-whole", temp)
    bits.destroy()
    sigs = sets.select("rep", "n", "sig")

    def with_both(pairs, a, b, what, *cols):
        for key, end in ((a, "_a"), (b, "_b")):
            pairs = pairs.join(what.select(F.col("rep").alias(key), *[F.col(c).alias(c + end) for c in cols]), key)
        return pairs.select(a, b, *[c + end for end in ("_a", "_b") for c in cols])

    def allowed(pairs, num, den):
        """(a, b) whose signatures allow Jaccard >= num / den."""
        return temp.written(with_both(pairs, "a", "b", sigs, "n", "sig").mapInArrow(lambda it: allowed_pairs(it, num, den), "a long, b long"), "sets-allowed")

    def verified(pairs):
        return temp.written(with_both(pairs, "a", "b", sets, "tokens").mapInArrow(lambda it: linked_pairs(it, num, den), "a long, b long"), "sets-links")

    edges = [verified(allowed(pairs, num, den))]
    for r in range(ROUNDS):
        live = hot.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(F.xxhash64("rep", F.lit(r)), "rep")).alias("p")).where("c > 1") \
            .select("token", F.col("p.rep").alias("pivot"))
        live = temp.written(hot.join(live, "token"), "sets-live")
        if live.isEmpty():
            hot = live
            break
        tries = live.groupBy("pivot", "rep").agg(F.count(F.lit(1)).alias("n")).select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
        tries = with_both(allowed(tries, 1, 2), "a", "b", sets, "tokens")
        compared = temp.written(tries.mapInArrow(lambda it: against_pivot(it, num, den), CLUSTER), "sets-compared")
        edges.append(temp.written(join_clusters(compared.withColumnRenamed("pivot", "cluster").drop("near"), num, den), "sets-links"))
        gone = compared.where("near").select("pivot", "rep").distinct()
        hot = temp.written(live.join(gone, ["pivot", "rep"], "left_anti").select("token", "rep"), "sets-hot")
    if not hot.isEmpty():
        rest = block_pairs(hot.join(sigs, "rep").withColumnRenamed("token", "cluster"))
        rest = rest.groupBy("cluster", "i", "j").applyInArrow(allowed_in_blocks(num, den), "a long, b long")
        edges.append(verified(temp.written(rest.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).drop("n"), "sets-allowed")))

    union = edges[0]
    for e in edges[1:]:
        union = union.unionByName(e)
    comp = components(union)
    named = classes.select("set_id", "n", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("set_id", "n", F.coalesce("component", "rep").alias("component_id"))
    named = written(named, "sets-named")
    temp.drop()
    linked = every.where("n > 0 and doc is not null").select("doc", "n", "set_id").join(named, ["set_id", "n"]).select("doc", "n", "component_id")
    alone = every.where("n = 0 or doc is null").select("doc", "n", F.col("doc").alias("component_id"))
    return linked.unionByName(alone).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
