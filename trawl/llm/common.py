"""Helpers shared by the operators: inputs, written cuts, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import shared_dir

#: A word: a run of anything but blank and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name in the storage that all executors share."""
    return shared_dir(spark, f"{tag}-{uuid.uuid4().hex}")


def written(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to shared storage and read back: computed
    once, lineage cut, and nothing lost with an executor."""
    path = path or scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of an operator's inner steps, deleted by ``drop`` once no
    lazy result reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, [], []

    def written(self, df: DataFrame, tag: str) -> DataFrame:
        self.paths.append(scratch(self.spark, tag))
        return written(df, tag, self.paths[-1])

    def drop(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for p in self.paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        self.paths, self.tables = [], []


def bucketed(df: DataFrame, key: str, tag: str, keep: Scratch) -> DataFrame:
    """``written``, and dealt into buckets by ``key``: joins on it shuffle the other
    side only. The table lives in shared storage; the catalog entry is the session's."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    keep.paths.append(path)
    name = f"{tag}_{uuid.uuid4().hex}".replace("-", "_")
    keep.tables.append(name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def sample_rows(df: DataFrame, key: Column, n: int) -> list:
    """At most ``n`` rows, the first by the long ``key`` (a hash) in a share of its range that
    holds about twice as many: what reaches the driver does not grow with the tasks."""
    space = 1 << 30
    keyed = df.withColumn("_at", F.pmod(key, F.lit(space)))
    total = keyed.count()
    share = space if total <= 2 * n else max(1, int(space * 2 * n / total))
    rows = keyed.where(F.col("_at") < share).collect()
    return sorted(rows, key=lambda r: (r["_at"], str(r)))[:n]


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b) as (node, component): the
    smallest node reachable, for every node that has an edge.

    Alternating large-star and small-star steps (Kiveris et al. 2014), each
    a group-by minimum and a join, until the edge set stops changing. A hub
    is safe: the minimum is pre-aggregated before the shuffle, and the join
    with the table of minima is one AQE may split. Every round is written
    to shared storage. Empty edges give an empty table.
    """
    temp, seen = Scratch(edges.sparkSession), None
    e = temp.written(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                     .where(F.col("a") != F.col("b")), "cc")
    for _ in range(max_rounds):
        # large star: every node links its larger neighbours to its smallest one
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        big = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: every node links its smaller neighbours and itself to the smallest
        down = big.where("a != b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).drop("n")
        low2 = down.groupBy("a").agg(F.min("b").alias("m"))
        star = (down.join(low2, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(low2.select("a", F.col("m").alias("b"))))
        before, temp = temp, Scratch(edges.sparkSession)
        e = temp.written(star.where("a != b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).drop("n"), "cc")
        before.drop()
        # a forest of stars onto minima no longer changes
        state = e.agg(F.count(F.lit(1)).alias("n"), F.sum("a").cast("decimal(38,0)").alias("s"),
                      F.sum("b").cast("decimal(38,0)").alias("t"),
                      F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == seen or state["n"] == 0:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
