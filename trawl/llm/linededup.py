"""Operator 6, line dedup by a suffix array over line-ID sequences. DataFrame operations only.

Documents are sequences of their lines that hold a word. Lines found once in
the corpus end every repeat, so the suffix array is built over the positions of repeated lines
alone: prefix doubling ranks each position by its first 1, 2, 4, ... lines
(rank pairs are numbered in sorted order by a range exchange and per-task
offsets), and positions of equal rank are the interval of the suffix array
whose common prefix is at least so long. A run of lines is identified by the
ranks of the two power-of-two prefixes that cover it. A run counts as repeated
when the shortest windows of ``min_words`` words that start and end in it do;
windows of one interval but not its first position are later copies, their union
are the maximal repeated runs, and those lines are deleted.

Positions are ordered by (doc_id, text hash, line). Runs of ``min_words`` words
have at most ``min_words`` lines, so the doubling has at most log2 of it steps,
however long the documents are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import WORD, Scratch, written

DOC = ["d", "h"]


def positions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, h, line, seq, words, key): the lines with a word, numbered within each document."""
    t = F.col(f"`{text_col}`").cast("string")
    lines = F.transform(F.split(t, "\n", -1), lambda x, i: F.struct(
        i.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("words"), F.md5(x).alias("key")))
    lines = F.filter(lines, lambda x: x["words"] > 0)
    return (docs.select(F.col(f"`{id_col}`").alias("d"), F.xxhash64(t).alias("h"), F.posexplode(lines).alias("seq", "x"))
            .select("d", "h", "seq", F.col("x.line").alias("line"), F.col("x.words").alias("words"), F.col("x.key").alias("key")))


def numbered(keys: DataFrame, cols: list[str], name: str, temp: Scratch) -> DataFrame:
    """Distinct ``cols`` with their rank in sorted order: a range exchange, then the
    row number in each part plus the rows of the parts before it."""
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = temp.written(keys.select(*cols).repartitionByRange(parts, *cols).withColumn("_pid", F.spark_partition_id()), "lines-rank")
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).drop("_n")  # one row per part
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*cols))
    return (ranged.withColumn("_local", local).join(F.broadcast(before), "_pid")
            .select(*cols, (F.col("_before") + F.col("_local")).alias(name)))


def windows(active: DataFrame, min_words: int) -> DataFrame:
    """(d, h, start, m): for each active line the shortest run of consecutive
    active lines with ``min_words`` words that starts there, and that ends there."""
    by_doc = Window.partitionBy(*DOC).orderBy("seq")
    a = active.withColumn("island", F.col("seq") - F.row_number().over(by_doc))
    island = [*DOC, "island"]
    cum = F.sum("words").over(Window.partitionBy(*island).orderBy("seq"))
    a = a.withColumn("c1", cum).withColumn("c0", F.col("c1") - F.col("words"))
    # asking rows (own: null) and told rows in one running aggregate, so the search stays linear
    ask = lambda x: a.select(*island, "seq", F.lit(None).cast("int").alias("own"), x.alias("x"))
    told = lambda x: a.select(*island, F.lit(None).cast("int").alias("seq"), F.col("seq").alias("own"), x.alias("x"))
    down = Window.partitionBy(*island).orderBy(F.col("x").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    up = Window.partitionBy(*island).orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = (ask(F.col("c0") + min_words).unionByName(told(F.col("c1"))).withColumn("e", F.min("own").over(down))
           .where("seq is not null and e is not null").select(*DOC, F.col("seq").alias("start"), F.col("e").alias("end")))
    back = (ask(F.col("c1") - min_words).unionByName(told(F.col("c0"))).withColumn("s", F.max("own").over(up))
            .where("seq is not null and s is not null").select(*DOC, F.col("s").alias("start"), F.col("seq").alias("end")))
    return (fwd.unionByName(back).groupBy(*DOC, "start", "end").agg(F.count(F.lit(1)).alias("n"))
            .select(*DOC, "start", (F.col("end") - F.col("start") + 1).alias("m")))


def later_runs(docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, h, line): lines inside later copies of repeated runs."""
    lines = positions(docs, id_col, text_col)
    seen = lines.select("d", "h", "seq", "line", "words", "key")
    repeated = seen.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    temp = Scratch(docs.sparkSession)
    rank0 = numbered(repeated, ["key"], "rank", temp)
    active = written(seen.join(rank0, "key").groupBy("d", "h", "seq")
                     .agg(F.first("line").alias("line"), F.first("words").alias("words"), F.first("rank").alias("rank")), "lines")
    runs = temp.written(windows(active, min_words).withColumn("k", F.floor(F.log2("m")).cast("int")), "lines-runs")
    deepest = runs.agg(F.max("k")).first()[0]
    if deepest is None:
        return active.where(F.lit(False)).select("d", "h", "line")
    level = active.select("d", "h", "seq", "rank")
    ranked = None
    for k in range(deepest + 1):
        r = runs.where(F.col("k") == k).withColumn("seq", F.col("start") + F.col("m") - (1 << k))
        one = level.select(F.col("d").alias("_d"), F.col("h").alias("_h"), F.col("seq").alias("_s"), F.col("rank").alias("ra"))
        two = level.select(F.col("d").alias("_d2"), F.col("h").alias("_h2"), F.col("seq").alias("_s2"), F.col("rank").alias("rb"))
        r = (r.join(one, r["d"].eqNullSafe(one["_d"]) & (r["h"] == one["_h"]) & (r["start"] == one["_s"]))
             .join(two, F.col("d").eqNullSafe(F.col("_d2")) & (F.col("h") == F.col("_h2")) & (F.col("seq") == F.col("_s2")))
             .select("d", "h", "start", "m", "ra", "rb"))
        ranked = r if ranked is None else ranked.unionByName(r)
        if k == deepest:
            break
        # doubling: the rank 2**k lines on, in the same document
        step = Window.partitionBy(*DOC).orderBy("seq").rangeBetween(1 << k, 1 << k)
        pairs = temp.written(level.withColumn("next", F.max("rank").over(step)).where("next is not null"), "lines-pairs")
        groups = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        order = numbered(groups, ["rank", "next"], "new", temp)
        level = temp.written(pairs.join(order, ["rank", "next"]).select("d", "h", "seq", F.col("new").alias("rank")), "lines-level")
    ranked = written(ranked, "lines-ranked")
    temp.drop()
    pos = F.struct(F.col("d").isNull().alias("n"), "d", "h", "start")
    first = ranked.groupBy("m", "ra", "rb").agg(F.min(pos).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    first = written(first, "lines-first")  # so that the join below is one AQE can split
    later = (ranked.join(first.select("m", "ra", "rb", "first"), ["m", "ra", "rb"])
             .where(~(F.col("first").eqNullSafe(pos)))
             .select("d", "h", F.col("start").alias("x"), (F.col("start") + F.col("m") - 1).alias("end"), F.lit(None).cast("int").alias("line")))
    marks = later.unionByName(active.select("d", "h", F.col("seq").alias("x"), F.lit(None).cast("int").alias("end"), "line"))
    reach = F.max("end").over(Window.partitionBy(*DOC).orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return marks.withColumn("reach", reach).where("line is not null and reach >= x").select("d", "h", "line")


def dedup(docs: DataFrame, *, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the text rid of later copies, plus _deleted (lines gone).

    The first copy in the order (doc_id, null last; hash of the text; line) stays
    whole. Lines without a word are never compared; they stay unless all
    other lines go, then the text is empty. A null or empty text stays as it is. Rows
    equal in doc_id and text are one document and get the same result. A copy
    may overlap itself: of a line repeated in place the first stays. Clashing
    input columns named _deleted are replaced; an empty table stays empty.
    """
    own = [c for c in docs.columns if c != "_deleted"]
    gone = later_runs(docs, min_words=min_words, id_col=id_col, text_col=text_col) \
        .groupBy(F.col("d").alias("_d"), F.col("h").alias("_h")).agg(F.collect_set("line").alias("_gone"))
    t = F.col(f"_row.`{text_col}`").cast("string")
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"))
    base = base.withColumn("_id", F.col(f"_row.`{id_col}`")).withColumn("_x", F.xxhash64(t))
    j = base.join(gone, base["_id"].eqNullSafe(gone["_d"]) & (base["_x"] == gone["_h"]), "left")
    lines = F.split(t, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    left = F.array_join(F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n")
    new = F.when(F.col("_gone").isNull(), t).when(left.rlike(WORD), left).otherwise(F.lit(""))
    return j.select(*[new.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in own],
                    F.coalesce(F.size("_gone"), F.lit(0)).alias("_deleted"))
