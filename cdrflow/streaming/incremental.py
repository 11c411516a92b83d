"""Incremental mode: Structured Streaming picks up new landing files.

A file stream over each landing folder lists new CSV files (path, length and
modification time only; the bytes are never read by the stream itself).
Each micro-batch hands its files to the batch load (``plans.batch_load``)
through ``foreachBatch``:

* schedule: ``trigger(processingTime="10 minutes")`` or ``availableNow``;
* no overlapping runs: one active query per checkpoint location, and each
  batch takes the warehouse's lease, so a batch beside another run fails;
* exactly once per file: the checkpoint's file log, plus skip-loaded,
  partition reload and insert-if-absent make a replayed batch harmless;
* cross-batch de-duplication: the merge's anti join on the key table;
* loaded and failed files go to OUT / ERR with ``LoadOptions(routes=...)``,
  replayed from a journal after a crash; ``cleanSource=archive`` is there too
  (best effort, see README);
* progress: each batch's files and bytes are published as observed metrics
  of the query; the rows that each step of the batch wrote are appended to the
  warehouse's ``progress`` table, row counts per file to the audit.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdrflow.plans.batch_load import LoadOptions, run_load
from cdrflow.sources.landing import CSV_GLOB

# Fixed schema of the binary-file source; ``content`` is never selected.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def landing_stream(spark: SparkSession, feeds: dict[str, str], max_files: int | None = None,
                   archive_dir: str | None = None) -> DataFrame:
    parts = []
    for feed, path in feeds.items():
        r = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", CSV_GLOB)
        if max_files:
            r = r.option("maxFilesPerTrigger", str(max_files))
        if archive_dir:
            r = r.option("cleanSource", "archive").option("sourceArchiveDir", f"{archive_dir}/{feed}")
        df = r.load(path).select("path", "length", "modificationTime")
        parts.append(
            df.where(F.col("length") > 0).select(
                F.lit(feed).alias("SOURCE_DIR"),
                F.element_at(F.split("path", "/"), -1).alias("FILE_NAME"),
                F.col("path").alias("FILE_PATH"),
                F.col("length").cast("bigint").alias("FILE_SIZE"),
                F.col("modificationTime").alias("MTIME"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def start_incremental(
    spark: SparkSession,
    feeds: dict[str, str],
    warehouse: str,
    checkpoint: str,
    trigger: str = "availableNow",
    options: LoadOptions = LoadOptions(),
    clock=None,
    max_files: int | None = None,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Start the incremental load; ``trigger`` is ``availableNow`` or an
    interval such as ``"10 minutes"``.  ``clock()`` gives the load time
    (``'YYYY-MM-DD HH:MM:SS'``) of a batch; by default the batch's wall time."""
    import datetime as dt

    def now() -> str:
        return (clock or (lambda: dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")))()

    def per_batch(files: DataFrame, epoch_id: int) -> None:
        run_load(files.sparkSession, feeds, warehouse, now(), options, listing=files)

    # progress of every micro-batch: files and bytes picked up, reported in
    # the query's progress (``observedMetrics``) next to its row counts
    stream = landing_stream(spark, feeds, max_files, archive_dir).observe(
        "landing", F.count(F.lit(1)).alias("files"), F.sum("FILE_SIZE").alias("bytes")
    )
    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.queryName(f"cdr_incremental_{hashlib.sha256(checkpoint.encode()).hexdigest()[:8]}").start()
