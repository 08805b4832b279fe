"""Session settings every trawl job relies on.

The runtime SQL settings are applied to whatever session the caller
hands in (``ensure_conf``), so a job gives the same answer under a
cluster session built elsewhere as under ``build_session`` in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings the operators depend on for their results.
RUNTIME_CONF = {
    # capture times are rendered as 14-digit UTC strings
    "spark.sql.session.timeZone": "UTC",
    # duplicate HTTP header names: the last one wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # let the archive source see simple predicates
    "spark.sql.python.filterPushdown.enabled": "true",
    # windows-1252 and friends for the charset decode
    "spark.sql.legacy.javaCharsets": "true",
    # malformed bytes become U+FFFD instead of failing the job (H3)
    "spark.sql.legacy.codingErrorAction": "true",
}

# Settings for throughput at scale; applied when we build the session.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.pythonUDF.arrow.enabled": "true",
    # no Python call site for each column: building long expressions is several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "trawl", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(TUNING_CONF)
    conf.update(RUNTIME_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the storage every executor sees.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    one machine is all there is, may do without: then we make our own and register it.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="trawl-shared-"))
        base = sc.getCheckpointDir()
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


class Workspace:
    """Inner tables of a job in shared storage: written once, deleted by ``close`` (or ``with``),
    at the latest when the application ends. A lazy result that reads them must be used before that."""

    def __init__(self, spark: SparkSession):
        self.spark, self._base, self._tables, self._buckets = spark, None, [], {}

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self._base)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def folder(self, tag: str) -> str:
        """The name of a new folder, which goes when the workspace does."""
        if self._base is None:
            self._base = shared_dir(self.spark, f"work-{uuid.uuid4().hex}")
            fs, at = self._fs()
            fs.mkdirs(at)
            fs.deleteOnExit(at)  # takes only what exists
        return f"{self._base}/{tag}-{uuid.uuid4().hex}"

    def written(self, df: DataFrame, tag: str) -> DataFrame:
        """``df`` computed once: its size is known from then on, and its lineage cut."""
        path = self.folder(tag)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, key: str, tag: str) -> DataFrame:
        """``written`` in as many buckets of ``key`` as there are shuffle partitions: a join or grouping by ``key``
        then moves the other side only. The table is in shared storage, its catalog entry the session's."""
        path, n = self.folder(tag), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"{tag}_{uuid.uuid4().hex}".replace("-", "_")
        df.write.bucketBy(n, key).option("path", path).format("parquet").saveAsTable(name)
        self._tables.append(name)
        self._buckets[name] = n
        return self.spark.table(name)

    def append(self, df: DataFrame, key: str) -> DataFrame:
        """Adds rows to the table made last by ``bucketed``, in its buckets."""
        name = self._tables[-1]
        df.write.bucketBy(self._buckets[name], key).format("parquet").mode("append").saveAsTable(name)
        return self.spark.table(name)

    def unlist(self) -> None:
        """Takes the tables out of the session's catalog. Their files stay, and results that read them already go on doing so."""
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables = []

    def close(self) -> None:
        self.unlist()
        if self._base is not None:
            fs, at = self._fs()
            fs.delete(at, True)
        self._base = None


def lookup_side(df: DataFrame, written: DataFrame) -> DataFrame:
    """A lookup table, no larger than the ``written`` one it is made of, as the side of a join that is built or moved: broadcast
    if the written files are under Spark's limit, else merged with the other side. The other side, whose size Spark
    underrates where rows are exploded, is never the one that is broadcast."""
    state = df.sparkSession._jsparkSession.sessionState()
    size = int(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= state.conf().autoBroadcastJoinThreshold() else df.hint("merge")
