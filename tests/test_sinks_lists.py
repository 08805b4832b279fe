"""Line-list inputs and the row/JSON sinks."""

from pyspark.sql import functions as F

from trawl.sources import sinks
from trawl.sources.lists import read_domain_hints, read_domain_list


def test_domain_list_is_verbatim_distinct_and_recursive(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "b").mkdir()
    (tmp_path / "a" / "l1.txt").write_text("x.de\nY.de\nx.de\n")
    (tmp_path / "a" / "b" / "l2.txt").write_text(" z.de\n\n")
    got = sorted(r[0] for r in read_domain_list(spark, str(tmp_path / "a")).collect())
    assert got == [" z.de", "Y.de", "x.de"]   # no trimming, case kept


def test_domain_hints_one_row_per_domain(spark, tmp_path):
    (tmp_path / "h.txt").write_text("a.de\t2\nb.de\tStand\nc.de\nb.de\tZeit\n")
    got = {r["domain"]: r["hint"] for r in read_domain_hints(spark, str(tmp_path)).collect()}
    assert got == {"a.de": "2", "b.de": "Zeit", "c.de": "c.de"}


def test_rows_and_json_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("u1", "2012\nline two", 200), ("u2", None, 404)], "url string, value string, s int")
    rows = spark.read.parquet(sinks.write_rows(df, str(tmp_path / "rows"), files=2))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    back = spark.read.schema("url string, value string, s int").json(
        sinks.write_json_lines(df, str(tmp_path / "json"), compression="gzip"))
    assert back.where(F.col("value").isNull()).count() == 1 and back.count() == 2
    text = spark.read.text(sinks.write_text(df.where("value is not null"), str(tmp_path / "txt")))
    assert sorted(r[0] for r in text.collect()) == ["2012", "line two"]   # newline splits the value


def _files(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("part-*.parquet")}


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    rows = [(f"k{i}", 0, i, 0, f"v{i}") for i in range(500)] + [(None, 0, 0, 0, "null")]
    schema = "id string, file int, rec_offset long, rec_index int, v string"
    table = sinks.upsert_buckets(spark, spark.createDataFrame(rows, schema), str(tmp_path / "t"), buckets=16)
    before = _files(tmp_path / "t")
    assert len(before) == 16  # one file a bucket: no task writes to two
    batch = spark.createDataFrame([("k7", 1, 1, 0, "new"), ("k7", 1, 0, 0, "older")], schema)
    for _ in range(2):  # a rerun agrees
        sinks.upsert_buckets(spark, batch, table, buckets=99)  # the table keeps its number of buckets
        after = _files(tmp_path / "t")
        kept = {p: t for p, t in after.items() if before.get(p) == t}
        assert len(after) == 16 and len(kept) == 15
        got = {r["id"]: r["v"] for r in sinks.read_buckets(spark, table).collect()}
        assert got == {r[0]: "new" if r[0] == "k7" else r[4] for r in rows}
    assert [r["v"] for r in sinks.read_buckets(spark, table, ["k7"]).collect()] == ["new"]
    sinks.upsert_buckets(spark, batch.limit(0), table)
    assert sinks.read_buckets(spark, table).count() == 501
    # a wide table: many shuffle partitions to a bucket, and a key of every bucket
    more = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(2).alias("file"), F.col("id").alias("rec_offset"),
                                    F.lit(0).alias("rec_index"), F.lit("w").alias("v"))
    sinks.upsert_buckets(spark, more, table)
    assert sinks.read_buckets(spark, table).groupBy("v").count().where("v = 'w'").first()["count"] == 2000


def test_an_empty_batch_makes_no_table_rows(spark, tmp_path):
    none = spark.createDataFrame([], "id string, file int, rec_offset long, rec_index int")
    table = sinks.upsert_buckets(spark, none, str(tmp_path / "t"))
    sinks.upsert_buckets(spark, spark.createDataFrame([("a", 1, 1, 1)], none.schema), table)
    assert sinks.read_buckets(spark, table).count() == 1
