"""Sinks (S4, S5, S6, X1) and the failure budget of a job.

Writers return the path they wrote so a caller (or a test) can read the
result back with Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.dedup import keep_latest
from trawl.session import Workspace


def fan_out(df: DataFrame, n: int | None) -> DataFrame:
    """Spread rows round-robin over ``n`` output files (the reference's
    100 identity reducers, without its single-null-key hot spot, D13)."""
    return df.repartition(n) if n else df


def write_text(df: DataFrame, path: str, value_col: str = "value", files: int | None = None,
               compression: str = "gzip") -> str:
    """One text line per row, compressed, replacing ``path``. Like the
    reference, a newline inside a value is not escaped."""
    fan_out(df.select(F.col(value_col).alias("value")), files).write.mode("overwrite") \
        .option("compression", compression).text(path)
    return path


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None) -> str:
    """S4's row-keeping alternative: the same rows as a table (parquet by
    default), where a value with newlines stays one row."""
    fan_out(df, files).write.mode("overwrite").format(fmt).save(path)
    return path


def write_json_lines(df: DataFrame, path: str, files: int | None = None,
                     compression: str | None = None) -> str:
    """One JSON object per line."""
    w = fan_out(df, files).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return path


def json_record(url="url", ts="ts14", content="html", mime="mime", status="status"):
    """S6's record layout: ``{url, ts, c, type, s}``."""
    return F.struct(F.col(url).alias("url"), F.col(ts).alias("ts"), F.col(content).alias("c"),
                    F.col(mime).alias("type"), F.col(status).alias("s"))


_BATCH = "_batch"


def _check_columns(docs: DataFrame, key: str) -> None:
    if _BATCH in docs.columns or key not in docs.columns:
        raise ValueError(f"documents need the column {key} and none named {_BATCH}")


def upsert_documents(spark: SparkSession, docs: DataFrame, out_path: str, existing_path: str | None = None,
                     key: str = "id", fmt: str = "parquet",
                     order: tuple[str, ...] = ("file", "rec_offset", "rec_index")) -> str:
    """S5 + A7: keyed document table. Within the batch the latest row per key
    wins; rows of the existing table (if any) whose key is not in the batch
    are kept. Spark cannot overwrite a table it is reading, so the merged
    table goes to ``out_path`` and callers move their pointer to it."""
    _check_columns(docs, key)
    # old rows rank below the batch, so one keep-latest over both is the upsert: the
    # batch is computed once, and the old table is read once
    rows = docs.withColumn(_BATCH, F.lit(1))
    if existing_path is not None:
        old = spark.read.format(fmt).load(existing_path)
        rows = rows.unionByName(old.select(*docs.columns).withColumn(_BATCH, F.lit(0)))
    merged = keep_latest(rows, key, (_BATCH, *order)).drop(_BATCH)
    merged.write.mode("overwrite").format(fmt).save(out_path)
    return out_path


# ---- failure budget (F7) ------------------------------------------------------

class FailureBudgetExceeded(RuntimeError):
    """Too large a share of the input could not be read; the result was not published."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def within_budget(failed: float, most: float | None) -> None:
    """Raises if the failed share is over the budget (None: any share passes)."""
    if most is not None and failed > most:
        raise FailureBudgetExceeded(f"{failed:.2%} of the records failed, {most:.2%} are allowed; nothing was published")


def publish(spark: SparkSession, path: str, write: Callable[[str], object], failed: Callable[[], float], most: float | None) -> str:
    """Writes a result next to ``path`` and moves it there only if the share of failed records, known once it is
    written, is within ``most``; else the old result stays and the new one goes. ``write`` takes the folder to write."""
    path = path.rstrip("/")
    staged, old = (f"{path}__{kind}-{uuid.uuid4().hex}" for kind in ("staged", "old"))
    fs, here = _fs(spark, path)
    there, away = _fs(spark, staged)[1], _fs(spark, old)[1]
    try:
        write(staged)
        within_budget(failed(), most)
        had = fs.exists(here)
        if had and not fs.rename(here, away):
            raise OSError(f"cannot move {path}")
        if not fs.rename(there, here):
            if had:
                fs.rename(away, here)
            raise OSError(f"cannot move {staged} to {path}")
        if had:
            fs.delete(away, True)
    finally:
        fs.delete(there, True)
    return path


# ---- upsert by bucket (S5) ----------------------------------------------------

#: Column of a bucketed document table: the folder a row lies in.
BUCKET = "_bucket"
_MARK = "_trawl_buckets"  # a file that Spark's readers skip


def _bucket_count(spark: SparkSession, path: str, wanted: int) -> tuple[int, bool]:
    """The number of buckets a table was made with, and whether it exists; a new one is made with ``wanted``."""
    fs, mark = _fs(spark, f"{path}/{_MARK}")
    if not fs.exists(mark):
        return wanted, False
    return int(spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(mark), "UTF-8")), True


def upsert_buckets(spark: SparkSession, docs: DataFrame, table: str, key: str = "id", buckets: int = 256,
                   order: tuple[str, ...] = ("file", "rec_offset", "rec_index"), failed: Callable[[], float] | None = None,
                   most: float | None = None, columns: list[str] | None = None) -> str:
    """S5 + A7, in place: a Parquet table keyed by ``key`` in folders of the key's hash. Only the buckets that a batch touches
    are read and rewritten, by dynamic partition overwrite; rows of other keys stay, and of equal keys in the batch the
    latest by ``order`` wins.

    The batch is written to the side first, so it is computed once; with ``failed`` and ``most`` it is merged only
    within the failure budget (F7). A bucket is replaced when the whole job commits; a batch that fails on the way is simply
    run again, and gives the same table. ``buckets`` counts for a new table; one that exists keeps its own. A null key is a key.
    """
    table = table.rstrip("/")
    if BUCKET in docs.columns or _BATCH in docs.columns or key not in docs.columns:
        raise ValueError(f"documents need the column {key} and none named {BUCKET} or {_BATCH}")
    n, exists = _bucket_count(spark, table, buckets)
    # Spark deals rows to partitions by the same hash: a multiple of n partitions never splits a task over buckets
    parts = n * -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // n)
    with Workspace(spark) as ws:
        batch = ws.written(docs.withColumn(BUCKET, F.pmod(F.hash(key), F.lit(n))), "batch")
        if failed is not None:
            within_budget(failed(), most)
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most n numbers
        rows = batch.withColumn(_BATCH, F.lit(1))
        if exists and touched:
            old = spark.read.schema(batch.schema).parquet(table).where(F.col(BUCKET).isin(touched))
            rows = rows.unionByName(old.withColumn(_BATCH, F.lit(0)))
        merged = keep_latest(rows.repartition(parts, key), key, (_BATCH, *order)).drop(_BATCH)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(table)
    if not exists:
        fs, mark = _fs(spark, f"{table}/{_MARK}")
        out = fs.create(mark, True)
        out.write(bytearray(str(n).encode()))
        out.close()
    return table


def read_buckets(spark: SparkSession, table: str, keys: list | None = None, key: str = "id") -> DataFrame:
    """A table of ``upsert_buckets``; with ``keys`` only their rows, from only their folders."""
    df = spark.read.parquet(table)
    if keys is not None:
        n, _ = _bucket_count(spark, table.rstrip("/"), 0)
        own = spark.createDataFrame([(k,) for k in keys], f"k {df.schema[key].dataType.simpleString()}").select(F.pmod(F.hash("k"), F.lit(n))).distinct()
        df = df.where(F.col(BUCKET).isin([r[0] for r in own.collect()]) & F.col(key).isin(keys))
    return df.drop(BUCKET)
