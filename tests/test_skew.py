"""Hot keys: one id / one source file holding a third of all rows."""

from pyspark.sql import functions as F

from trawl.operators.dedup import cap_per_file, keep_latest
from trawl.operators.stats import distinct_links


def _rows(spark, n=30000):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit("big.warc.gz")).otherwise(
            F.concat(F.lit("f"), (F.col("id") % 97).cast("string"))).alias("file"),
        F.col("id").alias("rec_offset"), F.lit(0).alias("rec_index"))
    return df.repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_keep_latest_with_a_hot_id(spark):
    out = keep_latest(_rows(spark), key="key", order=("file", "rec_offset"))
    hot = out.where(F.col("key") == "hot").collect()
    assert len(hot) == 1 and hot[0]["rec_offset"] == 29997   # greatest offset of the hot copies
    assert out.count() == 1 + 20000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "row_number(), 1, Partial" in _plan(out)       # copies collapse before the shuffle
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_cap_per_file_with_a_hot_file(spark):
    out = cap_per_file(_rows(spark), n=10)
    per_file = {r["file"]: r["count"] for r in out.groupBy("file").count().collect()}
    assert per_file["big.warc.gz"] == 10 and len(per_file) == 98
    assert sorted(r[0] for r in out.where(F.col("file") == "big.warc.gz").select("rec_offset").collect()) == \
        [3 * i for i in range(10)]


def test_in_degree_of_a_link_on_most_pages(spark):
    edges = spark.range(20000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("src"),
                                      F.lit("http://hot/").alias("link"))
    edges = edges.unionByName(edges)  # every edge twice
    got = {r["link"]: r["in_degree"] for r in distinct_links(edges).collect()}
    assert got == {"http://hot/": 20000}
