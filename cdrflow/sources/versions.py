"""Tables of rows that belong to files, with one current version of each file.

Every load writes its rows to a folder of its own (``LOAD=n``) and, before
that, a line per file to a small version table.  Readers take the rows whose
load is their file's current one, so an earlier version is out of sight as
soon as a new one begins, whether that has rows or not: an empty or
header-only file, one that fails, a run that is lost half way.  Dropping a
file is one more line; folders without a current file are deleted whole.

The number of folders follows the number of loads, not of files, and the
reader's schema comes from the version table, not from file footers.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.operators.maintain import current_files, current_rows
from cdrflow.sources import generations as G
from cdrflow.sources import shared_fs as FS

FILE = ["SOURCE_DIR", "SOURCE_FILE"]
VERSION_SCHEMA = "SOURCE_DIR string, SOURCE_FILE string, LOAD bigint, DROPPED boolean, COLUMNS string"


def _versions(path: str) -> str:
    return f"{path}/_versions"


def _rows(path: str) -> str:
    return f"{path}/rows"


def current_versions(spark: SparkSession, path: str) -> DataFrame:
    """(SOURCE_DIR, SOURCE_FILE, LOAD, COLUMNS) of every file that has not been dropped since its last load."""
    return current_files(G.read(spark, _versions(path), VERSION_SCHEMA))


def next_load(spark: SparkSession, path: str) -> int:
    last = G.read(spark, _versions(path), VERSION_SCHEMA).agg(F.max("LOAD")).first()[0]
    return 0 if last is None else int(last) + 1


def begin(files: DataFrame, path: str, load: int, columns: T.StructType) -> None:
    """Make ``load`` the current version of ``files``: their earlier rows are out of sight from now on."""
    described = T.StructType([f for f in columns.fields if f.name not in FILE]).json()
    lines = files.select(*FILE).distinct().select(
        *FILE, F.lit(load).cast("bigint").alias("LOAD"), F.lit(False).alias("DROPPED"), F.lit(described).alias("COLUMNS")
    )
    G.append(lines, _versions(path))


def write(rows: DataFrame, path: str, load: int) -> None:
    """The rows of a load; again for a load that was lost while writing, in its place."""
    rows.write.mode("overwrite").parquet(f"{_rows(path)}/LOAD={load}")


def add(rows: DataFrame, path: str, load: int) -> None:
    """More rows of a load that is written in parts."""
    rows.write.mode("append").parquet(f"{_rows(path)}/LOAD={load}")


def read_load(spark: SparkSession, path: str, load: int, columns: T.StructType) -> DataFrame:
    """Rows of one load, whatever else is there."""
    folder = f"{_rows(path)}/LOAD={load}"
    return spark.read.schema(columns).parquet(folder) if FS.exists(spark, folder) else spark.createDataFrame([], columns)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Current rows of every file; columns that a load did not have are NULL."""
    now = current_versions(spark, path)
    fields: dict[str, T.StructField] = {}
    for r in now.select("COLUMNS").distinct().collect():  # as many as there are layouts
        for f in T.StructType.fromJson(json.loads(r[0])).fields:
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    for c in FILE:
        fields[c] = T.StructField(c, T.StringType(), True)
    if not FS.exists(spark, _rows(path)):
        return spark.createDataFrame([], T.StructType(list(fields.values())))
    wanted = T.StructType([*fields.values(), T.StructField("LOAD", T.LongType(), True)])
    rows = spark.read.schema(wanted).parquet(_rows(path))
    return current_rows(rows, G.read(spark, _versions(path), VERSION_SCHEMA)).select(*fields)


def drop(files: DataFrame, path: str) -> None:
    """Drop ``files``: one line each; then folders that no current file has rows in are deleted."""
    spark = files.sparkSession
    lines = current_versions(spark, path).join(files.select(*FILE).distinct(), FILE, "left_semi").select(
        *FILE, "LOAD", F.lit(True).alias("DROPPED"), "COLUMNS"
    )
    G.append(lines, _versions(path))
    vacuum(spark, path)


def vacuum(spark: SparkSession, path: str) -> list[int]:
    """Delete the folders of loads without a current file; returns the loads."""
    live = {r[0] for r in current_versions(spark, path).select("LOAD").distinct().collect()}
    gone = [n for n in (int(x.split("=")[1]) for x in FS.names(spark, _rows(path)) if x.startswith("LOAD=")) if n not in live]
    for n in gone:
        FS.delete_path(spark, f"{_rows(path)}/LOAD={n}")
    return gone


def compact(spark: SparkSession, path: str) -> None:
    """Rewrite the version table to a line per file, the highest load kept so that numbers never come again."""
    everything = G.read(spark, _versions(path), VERSION_SCHEMA)
    G.replace(
        everything.groupBy(*FILE).agg(F.max(F.struct("LOAD", "DROPPED", "COLUMNS")).alias("LAST")).select(*FILE, "LAST.*"),
        _versions(path),
    )
