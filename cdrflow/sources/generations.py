"""Append-only tables that can be replaced as a whole, in one atomic step.

A table is a folder; a replacement is written to a folder of the next
generation, and a pointer file, created exclusively, makes it the table.  A
run lost at any point leaves either the old table or the new one: a folder
without a pointer is no table and is written anew by the next replacement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdrflow.sources import shared_fs as FS


def _pointers(path: str) -> str:
    return f"{path}.current"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in FS.names(spark, _pointers(path)) if n.isdigit()]


def _folder(path: str, generation: int) -> str:
    return f"{path}.g{generation}" if generation else path


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the table now; a table never replaced is ``path`` itself."""
    return _folder(path, max(_numbers(spark, path), default=0))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(current(df.sparkSession, path))


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, with its known schema; empty where nothing was written."""
    folder = current(spark, path)
    if not FS.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def replace(df: DataFrame, path: str) -> None:
    """Put ``df``, which may read the table, in its place; older generations go last."""
    spark = df.sparkSession
    numbers = _numbers(spark, path)
    last = max(numbers, default=0)
    new = _folder(path, last + 1)
    FS.delete_path(spark, new)  # of a run that was lost before its pointer
    df.write.parquet(new)
    if not FS.create_exclusive(spark, f"{_pointers(path)}/{last + 1:010d}"):
        raise OSError(f"{path} was replaced by another run meanwhile")
    for n in {0, last, *numbers}:
        FS.delete_path(spark, _folder(path, n))
        FS.delete_path(spark, f"{_pointers(path)}/{n:010d}")
