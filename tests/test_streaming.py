"""Incremental index over a folder that receives new archive files."""

from pyspark.sql import functions as F

from trawl.sources import fixtures as fx
from trawl.sources.webarchive import write_archive
from trawl.streaming.ingest import latest_version, start_incremental_index
from tests.conftest import SF_SMALL


def test_new_files_update_the_document_table(spark, tmp_path):
    archives, table, ckpt = str(tmp_path / "in"), str(tmp_path / "docs"), str(tmp_path / "ckpt")
    recs = fx.capture_records(spark, SF_SMALL)
    write_archive(recs.drop("page_id"), f"{archives}/day1")
    gaz = fx.gazetteer(spark, SF_SMALL)

    start_incremental_index(spark, archives, table, ckpt, gaz, available_now=True).awaitTermination()
    first = spark.read.parquet(latest_version(table))
    n_first = first.count()
    assert n_first > 0 and first.select("id").distinct().count() == n_first

    # a later crawl recaptures every page with a new body: same ids, new text
    later = recs.drop("page_id").withColumn(
        "content", F.concat(F.col("content"), F.encode(F.lit("<p>" + "update " * 30 + "</p>"), "UTF-8")))
    write_archive(later, f"{archives}/day2")
    start_incremental_index(spark, archives, table, ckpt, gaz, available_now=True).awaitTermination()
    second = spark.read.parquet(latest_version(table))
    assert second.count() == n_first
    assert second.where(F.col("html").contains("update update")).count() == n_first
