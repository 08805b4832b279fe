"""Operator 13, ranked lexical search over length-ordered buckets (LEMP).

Every document is a vector over the terms that the query items hold, every item another;
a score is their inner product (Teflioudi, Gemulla, Mykytiuk: LEMP, SIGMOD 2015). With
w the weight of a term and x its impact in a document, both vectors carry
the root of w, so that frequent terms, whose weight is near 0, add no length.

1. The item set is read in blocks of bounded numbers of terms. Term counts of all whole
   texts are written once for a block; document frequencies, N and L are aggregates of them.
2. The vectors are ordered by length, longest first, by a range exchange; a hash of the
   row splits ties, so copies spread. Each task cuts its run into buckets.
3. Cauchy-Schwarz: an item whose length times the bucket's greatest length is below the item's
   k-th score so far is done with this and every later bucket of the task.
4. Inside a bucket the item's heaviest coordinates bound each vector: their own products plus
   the product of what length is left on both sides.
5. What survives is scored exactly, in 64-bit integers over all of the item's terms.

A first search over a hash share of the vectors gives each item a score that ten documents
reach; every task starts from it. Bounds are widened by a relative 1e-9 against rounding, so no
document is lost, ties included.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import Scratch

#: Terms: runs of ASCII letters and digits and of all bytes of non-ASCII characters, once A-Z are lower-cased.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_TERM = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Bytes of a text that are read at a time.
PIECE = 1 << 20
#: Terms of a block of items (a single item may have more): what is sent to the tasks is bounded by it.
BLOCK_TERMS = 1 << 16
BUCKET = 2048
#: Heaviest coordinates of an item that bound a vector before it is scored.
FOCUS = 4
#: One of so many vectors is searched first, for a start of the thresholds.
SEED = 16
SLACK = 1e-9


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, with repeats, in order; one list for each piece of about ``PIECE`` bytes."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            gap = NO_TERM.search(data, end)
            end = gap.start() if gap else len(data)
        yield TERM.findall(data[at:end].lower())
        at = end


def _bytes(column: pa.Array) -> list:
    return column.cast(pa.large_binary()).to_pylist()


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, ids, tfs) of the documents with a term: n of all terms, ids and tfs of the known ones."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most BLOCK_TERMS terms, or one item's

    def count(batches):
        look = known.value.get
        for b in batches:
            keep, ns, ids, tfs = [], [], [], []
            for i, data in enumerate(_bytes(b.column(1))):
                n, found = 0, []
                for words in terms(data or b""):
                    n += len(words)
                    t, c = np.unique(np.array([k for k in map(look, words) if k is not None], np.int32), return_counts=True)
                    found.append((t, c))
                if not n:
                    continue
                t, c = found[0]
                if len(found) > 1:
                    t, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                    c = np.bincount(back, np.concatenate([f[1] for f in found]), len(t)).astype(np.int64)
                keep.append(i), ns.append(n), ids.append(t), tfs.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array(ns, pa.int64()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "ids", "tfs"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(count, schema)


def impacts(counts: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, length, ids, x): impact vectors that are not zero. ``x`` is the integer impact of each
    term, ``length`` the norm of sqrt(weight) * x."""
    def weigh(batches):
        for b in batches:
            ids, tfs = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()
            size = np.diff(b.column(2).offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), size)
            m = 100 - 90 + (90 * b.column(1).to_numpy() * n_docs) // n_terms
            x = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[row])
            good = (weights[ids] > 0) & (x > 0)
            ids, x, row = ids[good], x[good], row[good]
            length = np.sqrt(np.bincount(row, weights[ids] * x.astype(float) ** 2, len(size)))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(length), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(x, pa.int64()))], ["doc_id", "length", "ids", "x"])
            yield out.filter(pa.array(length > 0))

    schema = T.StructType([counts.schema["doc_id"], T.StructField("length", T.DoubleType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.LongType()))])
    return counts.mapInArrow(weigh, schema)


class Item:
    """One query vector: its terms, their weights, the heaviest ones first, and the scores it has found."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, floor: int, k: int):
        w = weights[ids]
        order = np.lexsort((ids, -w))
        self.ids, self.w = ids[order][w[order] > 0], w[order][w[order] > 0]
        self.length, self.k, self.floor, self.best = math.sqrt(float(self.w.sum())), k, max(floor, 1), []
        self.focus = min(FOCUS, len(self.ids))
        self.rest = math.sqrt(float(self.w[self.focus:].sum()))

    def found(self, scores, docs) -> None:
        """Keeps the ``k`` best of all found so far: greatest score, then smallest id, null last."""
        self.best = sorted(self.best + list(zip(scores, docs)), key=lambda s: (-s[0], s[1] is None, 0 if s[1] is None else s[1]))[: self.k]
        if len(self.best) == self.k:
            self.floor = max(self.floor, self.best[-1][0])


def search_bucket(items: list[Item], docs, length: np.ndarray, size: np.ndarray, ids: np.ndarray, x: np.ndarray) -> list[Item]:
    """Scores one bucket (vectors by falling length) against the items; returns those still worth a later one."""
    items = [q for q in items if q.length * length[0] * (1 + SLACK) >= q.floor]
    if not items:
        return items
    order = np.argsort(ids, kind="stable")
    row, ids, x = np.repeat(np.arange(len(size)), size)[order], ids[order], x[order]
    for q in items:
        lo, hi = np.searchsorted(ids, q.ids, "left"), np.searchsorted(ids, q.ids, "right")
        inner, square = np.zeros(len(size)), np.zeros(len(size))
        for j in range(q.focus):
            r, v = row[lo[j]:hi[j]], x[lo[j]:hi[j]].astype(float)
            inner[r] += q.w[j] * v
            square[r] += q.w[j] * v * v
        bound = inner + q.rest * np.sqrt(np.maximum(length * length * (1 + SLACK) - square, 0.0))
        alive = bound * (1 + SLACK) >= q.floor
        if not alive.any():
            continue
        score = np.zeros(len(size), np.int64)
        for j in range(len(q.ids)):
            r = row[lo[j]:hi[j]]
            on = alive[r]
            score[r[on]] += q.w[j] * x[lo[j]:hi[j]][on]
        hit = np.flatnonzero(score >= q.floor)
        if len(hit):
            q.found(score[hit].tolist(), [docs[i] for i in hit])
    return items


def search_vectors(vectors: DataFrame, queries: list[np.ndarray], weights: np.ndarray, floors: dict[int, int], k: int) -> DataFrame:
    """(item, doc_id, score): of every task, the ``k`` best documents of each item that reach its floor."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries, weights, floors))  # one block of items

    def search(batches):
        queries, weights, floors = shared.value
        every = [Item(ids, weights, floors.get(i, 1), k) for i, ids in enumerate(queries)]
        live = [q for q in every if len(q.ids)]
        for b in batches:
            for at in range(0, b.num_rows, BUCKET):
                c = b.slice(at, BUCKET)
                if not live:
                    break
                live = search_bucket(live, c.column(0).to_pylist(), c.column(1).to_numpy(), np.diff(c.column(2).offsets.to_numpy()),
                                     c.column(2).flatten().to_numpy(), c.column(3).flatten().to_numpy())
        rows = [(i, d, s) for i, q in enumerate(every) for s, d in q.best]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type),
                                          pa.array([r[2] for r in rows], pa.int64())], ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(vectors.schema["doc_id"].dataType)
    schema = T.StructType([T.StructField("item", T.IntegerType()), vectors.schema["doc_id"], T.StructField("score", T.LongType())])
    return vectors.mapInArrow(search, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[list]:
    """Blocks of (item_id, distinct terms), each of at most ``BLOCK_TERMS`` terms or of one item."""
    block, size = [], 0
    for r in items.toLocalIterator():
        found = sorted({t for words in terms((r["text"] or "").encode()) for t in words})
        if block and size + len(found) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], found))
        size += len(found)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every row of ``items``, all with a score
    above 0 if there are fewer; equal scores by ascending id, a null id last.

    Every row of ``docs`` counts as a document and every row of ``items`` as an item, repeated ones and
    null ids included. A null text has no term; such items, those whose terms are in no document, and
    empty tables give no rows. Other columns of the inputs, whatever their names, are not read.
    The result, at most ``k`` rows an item, is a written table.
    """
    spark = docs.sparkSession
    rows = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    keep, results = Scratch(spark), []
    for block in _blocks(rows):
        inner = Scratch(spark)
        vocabulary: dict[bytes, int] = {}
        queries = [np.array([vocabulary.setdefault(t, len(vocabulary)) for t in found], np.int32) for _, found in block]
        if not vocabulary:
            continue
        counts = inner.written(count_terms(docs, vocabulary, id_col, text_col), "lemp-counts")
        totals = counts.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_terms")).first()
        if totals["n_docs"]:
            n = totals["n_docs"]
            df = np.zeros(len(vocabulary), np.int64)  # at most BLOCK_TERMS rows
            for r in counts.select(F.explode("ids").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
                df[r["t"]] = r["df"]
            weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
            vectors = impacts(counts, weights, n, totals["n_terms"])
            parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
            at = F.xxhash64("doc_id", "ids", "x")
            seeds = vectors.where(F.pmod(at, F.lit(SEED)) == 0).repartition(max(1, parts // SEED))
            first = _ranked(search_vectors(seeds.sortWithinPartitions(F.col("length").desc()), queries, weights, {}, k), k)
            floors = {r["item"]: r["score"] for r in first.where(F.col("rank") == k).select("item", "score").collect()}  # one an item
            ordered = vectors.repartitionByRange(parts, F.col("length").desc(), at).sortWithinPartitions(F.col("length").desc())
            best = _ranked(search_vectors(ordered, queries, weights, floors, k), k)
            names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)],
                                          T.StructType([T.StructField("item", T.IntegerType()), rows.schema["item_id"]]))
            results.append(keep.written(best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "lemp"))
        inner.drop()
    none = spark.createDataFrame([], T.StructType([rows.schema["item_id"], T.StructField("rank", T.IntegerType()),
                                                   T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())]))
    out = None
    for r in results:
        out = r if out is None else out.unionByName(r)
    return none if out is None else out
