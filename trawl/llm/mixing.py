"""Operator 4, mixing sources to target weights by entropy balancing.

Every document gets a rate w, the point closest in relative entropy to
"each document once" under the constraints that each source's taken tokens
meet its target and that no rate passes the ceiling:
``w = min(ceiling, exp(lambda_s * size / mean size of s))``. The convex dual
has one multiplier for each source; all are found together by safeguarded
Newton steps, each one aggregate over the (source, size, count) histogram.
Sums are exact decimals of rates in 2**-20 steps, so reruns agree bit for
bit whatever the order of the rows.

Rates become copies by cumulative rounding along the order (source, size,
hash): ``floor(C + w) - floor(C)`` with C the rates so far. A source's error is
then below about one document, and no document gets more than the ceiling.
The order is cut by a range exchange with the hash as tie-breaker, so a hot
source or a large group of equal sizes spreads over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import Scratch, count_words, written
from trawl.llm.linededup import numbered

ONE = 1 << 20  # fixed-point unit of a rate
MAX_NEWTON = 60
TOLERANCE = 1e-5


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, ceiling: int = 2) -> DataFrame:
    """(source, sid, n_docs, source_size, weight, target) from (source, size, n).

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share ``share`` of all sizes; a target stops at ``ceiling`` times its
    source's size and the excess is reshared by weight until none is above.
    """
    temp = Scratch(sizes.sparkSession)
    src = written(sizes.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum(F.col("n") * F.col("size")).alias("source_size")), "mix-sources")
    # numbered by a range exchange; a null source comes behind all others
    ids = numbered(src.where("source is not null"), ["source"], "sid", temp)
    last = src.agg(F.count("source")).first()[0] + 1
    src = (src.join(ids, "source", "left").withColumn("sid", F.coalesce("sid", F.lit(last)).cast("long"))
           .withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                              (((F.col("sid") - 1) % len(weights)) + 1).cast("int"))))
    src = written(src, "mix-sources")
    temp.drop()
    most = F.col("source_size") * float(ceiling)
    total = (src.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:  # raise the common level until no further source reaches its ceiling
        free = most > F.col("weight") * level
        a = src.agg(F.sum(F.when(~free, most)).alias("c"), F.sum(F.when(free, F.col("weight"))).alias("w")).first()
        if not a["w"]:
            break
        new = (total - (a["c"] or 0.0)) / a["w"]
        if new <= level:
            break
        level = new
    return src.withColumn("target", F.least(most, F.col("weight") * F.lit(level)))


def multipliers(hist: DataFrame, src: DataFrame, ceiling: int = 2) -> DataFrame:
    """``src`` with the dual's multiplier ``lam`` (null: every rate is the ceiling)."""
    top = float(np.log(ceiling))
    at_top = F.col("target") >= F.col("source_size") * float(ceiling)
    state = (src.withColumn("mean", F.col("source_size") / F.col("n_docs"))
             .withColumn("lam", F.when(at_top, F.lit(None)).otherwise(F.lit(0.0)).cast("double"))
             .withColumn("lo", F.lit(-4096.0)).withColumn("hi", F.lit(4096.0)).withColumn("done", at_top))
    state = written(state, "mix-dual")
    for _ in range(MAX_NEWTON):
        x = F.col("size") / F.col("mean")
        z = F.col("lam") * x
        rate = F.exp(F.least(z, F.lit(top)))
        mass = (F.col("n") * F.col("size")).cast("decimal(20,0)")
        fixed = lambda v: F.floor(v * ONE).cast("decimal(17,0)")
        sums = (hist.join(state.where("not done").select("sid", "lam", "mean"), "sid")
                .groupBy("sid").agg(
                    F.sum(mass * fixed(rate)).cast("double").alias("f"),
                    F.sum(mass * fixed(F.when(z < top, rate * x).otherwise(0.0))).cast("double").alias("g")))
        j = state.join(sums, "sid", "left")
        f, g = F.col("f") / ONE, F.col("g") / ONE
        over = f > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - (f - F.col("target")) / g
        good = (g > 0) & (step > lo) & (step < hi)
        close = F.abs(f - F.col("target")) <= F.greatest(F.col("target") * TOLERANCE, F.lit(0.5))
        stuck = (F.col("hi") - F.col("lo")) < 1e-12
        nxt = F.when(good, step).otherwise((lo + hi) / 2)
        state = written(
            j.withColumn("nlam", F.when(F.col("done") | close | stuck, F.col("lam")).otherwise(nxt))
            .withColumn("nlo", F.when(F.col("done"), F.col("lo")).otherwise(lo))
            .withColumn("nhi", F.when(F.col("done"), F.col("hi")).otherwise(hi))
            .withColumn("ndone", F.col("done") | F.coalesce(close | stuck, F.lit(True)))
            .select(*[F.col(c) for c in state.columns if c not in ("lam", "lo", "hi", "done")],
                    F.col("nlam").alias("lam"), F.col("nlo").alias("lo"), F.col("nhi").alias("hi"),
                    F.col("ndone").alias("done")), "mix-dual")
        if state.where("not done").isEmpty():
            break
    return state.drop("lo", "hi", "done")


def _running(batches):
    """Adds the task's number and the running sum of the fixed-point rates."""
    part, so_far = TaskContext.get().partitionId(), 0
    for b in batches:
        run = np.cumsum(b.column(b.schema.get_field_index("_w")).to_numpy(), dtype=np.int64) + so_far
        if len(run):
            so_far = int(run[-1])
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(len(run), part), pa.int32()), pa.array(run, pa.int64())],
            [*b.schema.names, "_part", "_run"])


def mix(docs: DataFrame, *, weights=(3, 1, 2), share: float = 1.5, ceiling: int = 2, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", size_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus _size, _source_size, _target, _copies.

    _size counts the words of the whole text (null: 0), or is ``size_col`` where
    the caller has counted already; _copies is how often
    the mix takes the document, 0 to ``ceiling``. A null source is a source
    of its own, last in order. Documents without words are kept once, since
    they cost no tokens. Repeated rows count one by one, and between equal
    rows it does not matter which gets the extra copy. An empty table gives
    an empty result. Input columns of the added names are replaced.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("_size", "_source_size", "_target", "_copies")]
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
                        F.col(f"`{source_col}`").cast("string").alias("source"),
                        F.xxhash64(F.col(f"`{id_col}`")).alias("h"),
                        (F.col(f"`{size_col}`").cast("long") if size_col else count_words(F.col(f"`{text_col}`"))).alias("size"))
    hist = written(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-hist")
    src = source_targets(hist, weights, share, ceiling)
    hist = hist.join(src.select("source", "sid"), hist["source"].eqNullSafe(src["source"])).select("sid", "size", "n")
    hist = written(hist, "mix-hist")
    dual = multipliers(hist, src, ceiling)
    z = F.col("lam") * F.col("size") / F.col("mean")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("lam").isNull(), F.lit(float(ceiling))) \
        .otherwise(F.least(F.exp(z), F.lit(float(ceiling))))
    known = dual.select(F.col("source").alias("_s"), "sid", "lam", "mean", F.col("source_size"), "target")
    rated = (sized.join(known, sized["source"].eqNullSafe(known["_s"]))
             .withColumn("_w", F.floor(rate * ONE).cast("long"))
             .select("row", "h", "size", "sid", "source_size", "target", "_w"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["sid", "size", "h"]
    ranged = rated.repartitionByRange(parts, *order, F.xxhash64("row")).sortWithinPartitions(*order, F.xxhash64("row"))
    schema = T.StructType([*ranged.schema.fields, T.StructField("_part", T.IntegerType()),
                           T.StructField("_run", T.LongType())])
    ran = written(ranged.mapInArrow(_running, schema), "mix-rates")
    # one row a task: bounded by the number of shuffle partitions, not by the data
    ends = sorted((r["_part"], r["end"]) for r in ran.groupBy("_part").agg(F.max("_run").alias("end")).collect())
    before, starts = 0, []
    for part, end in ends:
        starts.append((part, before % ONE))
        before += end
    offsets = spark.createDataFrame(starts, "_part int, _before long")
    c1 = F.col("_before") + F.col("_run") + ONE // 2
    copies = F.shiftright(c1, 20) - F.shiftright(c1 - F.col("_w"), 20)
    return (ran.join(F.broadcast(offsets), "_part")
            .select("row.*", F.col("size").alias("_size"), F.col("source_size").alias("_source_size"),
                    F.col("target").alias("_target"), copies.alias("_copies")))
