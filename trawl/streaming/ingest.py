"""Incremental indexing of a growing archive folder (Structured Streaming).

The reference runs its index job over a fixed path. Crawls keep writing
new archive files, so this module runs the same batch job per
micro-batch of *new files*. The file stream only lists paths: the
``binaryFile`` source prunes its ``content`` column when it is not
selected, so no archive bytes go through it. ``foreachBatch`` reads those
files with the ``webarchive`` source, builds their documents
(``plans.jobs.documents``) and upserts them into a document table in folders of the id's hash
(``sinks.upsert_buckets``): a micro-batch rewrites the buckets it touches and no other.

A rerun of a batch after a failure merges the same rows again, which changes nothing, so the sink is idempotent, and
the checkpoint folder gives the usual exactly-once file tracking. A batch over the failure budget stops the
query before it is merged; its inner tables are deleted with it. Plain Parquet folders give readers no snapshot: a reader
that must not see a batch half committed needs a table format, with its MERGE in place of the upsert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trawl.plans import jobs
from trawl.session import Workspace
from trawl.sources import sinks
from trawl.sources.webarchive import _fs_and_path, read_archive

ARCHIVE_GLOB = "*.{warc,arc,warc.gz,arc.gz}"
# The binaryFile source's fixed schema (streams must declare it).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def latest_version(table_dir: str) -> str | None:
    """Path of the document table, if it has been written (there is one version, updated in place)."""
    from pyarrow import fs as pafs
    fs, root = _fs_and_path(table_dir)
    return table_dir.rstrip("/") if fs.get_file_info(root).type == pafs.FileType.Directory else None


def start_incremental_index(spark: SparkSession, archive_dir: str, table_dir: str, checkpoint_dir: str,
                            gazetteer: DataFrame, max_files_per_trigger: int = 1000,
                            available_now: bool = False, buckets: int = 256, max_failed: float | None = 0.05, **scan_options) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``scan_options`` are passed to the ``webarchive`` reader. With
    ``available_now`` the query processes what is there and stops. ``buckets`` counts for a new table, ``max_failed`` is the
    share of unreadable records up to which a batch is merged (None: any)."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", ARCHIVE_GLOB)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", str(max_files_per_trigger))
             .load(archive_dir)
             .select("path"))

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # the paths of one micro-batch: at most max_files_per_trigger names
        paths = [r["path"] for r in batch.collect()]
        if not paths:
            return
        records = read_archive(spark, paths, **scan_options)
        seen = Observation(f"batch-{batch_id}")
        with Workspace(spark) as ws:
            docs = jobs.documents(records, gazetteer, ws=ws, observation=seen)
            sinks.upsert_buckets(spark, docs, table_dir, buckets=buckets, order=(), failed=lambda: jobs.failed_share(seen.get), most=max_failed)

    writer = files.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
