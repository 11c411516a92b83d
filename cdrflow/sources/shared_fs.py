"""File-system calls of the driver: paths and small marker files, never data.

``create_exclusive`` is the one primitive that leases and table generations
stand on: of any number of callers, one creates the file.
"""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it is not there."""
    fs, p = fs_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def modified_ms(spark: SparkSession, path: str) -> int | None:
    fs, p = fs_path(spark, path)
    return int(fs.getFileStatus(p).getModificationTime()) if fs.exists(p) else None


def rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, s = fs_path(spark, source)
    _, t = fs_path(spark, target)
    fs.mkdirs(t.getParent())
    return bool(fs.rename(s, t))


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    fs, p = fs_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(b for b in (stream.read() for _ in range(n)) if b >= 0)
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Creates the file, or returns False because it is there.

    The store decides which of two callers wins: HDFS does so for ``create``
    without overwriting, a local disk only for its own exclusive mode.
    """
    fs, p = fs_path(spark, path)
    fs.mkdirs(p.getParent())
    if p.toUri().getScheme() == "file":
        try:
            handle = os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            return False
        with os.fdopen(handle, "w") as out:
            out.write(text)
        return True
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def shared_root(spark: SparkSession) -> str:
    """The folder for written intermediates: ``spark.checkpoint.dir``, or the warehouse where none is named.

    On a cluster a warehouse on a local disk is none, as executors do not share it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir")
    master = spark.sparkContext.master
    on_one_machine = master.startswith("local") and not master.startswith("local-cluster")
    if not on_one_machine and fs_path(spark, root)[1].toUri().getScheme() == "file":
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return root.rstrip("/")
