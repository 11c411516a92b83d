"""Storage of the staging, detail, key and audit tables (parquet folders).

* staging: a folder per load and a version table (``sources.versions``); a
  reload hides a file's earlier rows, whatever it brings itself;
* detail: append-only, partitioned by START_DAY (day of START_DATE) so the
  monitoring queries prune days;
* keys: by default the detail table's key column; optionally a catalog
  table bucketed by key so the merge's anti join does not shuffle it;
* audit: append-only event log, replaced as a whole by the retention
  (``sources.generations``); ``audit_latest`` gives the current state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.mapping import AUDIT_SCHEMA
from cdrflow.sources import generations as G
from cdrflow.sources import versions as V
from cdrflow.sources.shared_fs import delete_path, exists, shared_root

STAGING_PARTS = ["SOURCE_DIR", "SOURCE_FILE"]
AUDIT_EVENT_SCHEMA = T.StructType([*AUDIT_SCHEMA.fields, T.StructField("SEQ", T.LongType(), True)])

__all__ = ["delete_path", "exists"]


def shared_copy(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    The folder is that of ``shared_root``.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/cdrflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_staging(df: DataFrame, path: str, load: int | None = None, files: DataFrame | None = None) -> int:
    """Rows of a load: its files' earlier rows are out of sight before the first new one is written.

    ``files`` are the load's files, also those without a row (by default the
    files of ``df``); ``load`` is higher than that of any load before (by
    default the next number).  Returns ``load``.
    """
    n = V.next_load(df.sparkSession, path) if load is None else load
    V.begin(df if files is None else files, path, n, df.schema)
    V.write(df, path, n)
    return n


def read_staging(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """Current rows of all files, or of ``files``; an absent or empty table gives no rows."""
    df = V.read(spark, path)
    return df if files is None else df.join(files.select(*STAGING_PARTS), STAGING_PARTS, "left_semi")


def drop_staging_files(spark: SparkSession, path: str, files: DataFrame) -> None:
    """Drop the rows of ``files``; folders of loads that have no file left are deleted."""
    V.drop(files, path)


def append_detail(df: DataFrame, path: str, seen: Observation | None = None) -> None:
    """Append, one day after the other: few files a day, and a large day in several of bounded size.

    ``seen`` gets the number of ``rows``, counted where they are written.
    """
    days = df.withColumn("START_DAY", F.col("START_DATE").cast(T.DateType())).hint("rebalance", "START_DAY")
    (
        (days if seen is None else days.observe(seen, F.count(F.lit(1)).alias("rows")))
        .write.mode("append")
        .partitionBy("START_DAY")
        .parquet(path)
    )


def append_keys(keys: DataFrame, table: str, buckets: int = 64) -> None:
    """Append new keys to the bucketed key table; ``buckets`` is that of a table not yet there."""
    k = keys.select(F.col("DEDUP_KEY").cast(T.StringType()))
    k.write.mode("append").bucketBy(_buckets(keys.sparkSession, table, buckets), "DEDUP_KEY").sortBy("DEDUP_KEY").saveAsTable(table)


def _buckets(spark: SparkSession, table: str, default: int) -> int:
    """An existing table keeps its bucket count."""
    if not spark.catalog.tableExists(table):
        return default
    found = [r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Num Buckets"]
    return int(found[0]) if found else default


def read_keys(spark: SparkSession, table: str) -> DataFrame:
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], "DEDUP_KEY string")


def append_audit(events: DataFrame, path: str) -> None:
    G.append(events, path)


def read_audit_events(spark: SparkSession, path: str) -> DataFrame:
    return G.read(spark, path, AUDIT_EVENT_SCHEMA)


def replace_audit(events: DataFrame, path: str) -> None:
    """Put ``events``, which may read the audit, in its place: atomic, see ``sources.generations``."""
    G.replace(events, path)


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> dict:
    """Refresh optimizer statistics of a catalog table (row count, size and,
    with ``columns``, column statistics) and return the table-level ones."""
    cols = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{cols}")
    stats = {}
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r[0] == "Statistics":
            for part in r[1].split(","):
                v, _, unit = part.strip().partition(" ")
                stats[unit] = int(v)
    return stats
