"""Line-list inputs (S3): domain allow-lists and domain hints.

The reference reads every file under a directory, line by line, verbatim
(no trimming, case kept), into an in-memory map in each task. Here the list
is a DataFrame; the join decides whether to broadcast it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_domain_list(spark: SparkSession, path: str) -> DataFrame:
    """S3: distinct lines of every file under ``path`` (recursively)."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("value").alias("domain")).where(F.col("domain") != "").distinct()


def read_domain_hints(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """``domain<sep>hint`` lines; a line without a separator is its own hint,
    as in the reference's line->line map. One row per domain (the
    lexicographically greatest line wins, so reruns agree)."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).where(F.col("value") != "")
    parts = F.split(F.col("value"), sep, 2)
    pairs = lines.select(parts.getItem(0).alias("domain"),
                         F.coalesce(F.get(parts, 1), parts.getItem(0)).alias("hint"))
    return pairs.groupBy("domain").agg(F.max("hint").alias("hint"))
