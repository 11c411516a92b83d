"""Landing files go to OUT or ERR once their outcome stands in the audit.

The renames that a run intends are written to a journal before its audit
events, under the events' sequence number.  They are done after the events,
and again by the next run if this one is lost in between; a journal without
its events belongs to a run that will be repeated, and is dropped.  A rename
is done only for the file that was loaded (same size and time), so replaying
is harmless even if a new file of that name has landed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.sources import shared_fs as FS

JOURNAL_SCHEMA = "SOURCE string, TARGET string, FILE_SIZE bigint, MTIME_MS bigint"


@dataclass(frozen=True)
class Routes:
    """Folders that take the files of good and of failed outcomes, below them one per feed."""

    out: str
    err: str


def intended(outcomes: DataFrame, routes: Routes) -> DataFrame:
    """A rename for each file with an outcome (SOURCE_DIR, FILE_NAME, FILE_PATH, FILE_SIZE, MTIME, STATUS)."""
    root = F.when(F.col("STATUS") == "SUCCESS", F.lit(routes.out.rstrip("/"))).otherwise(F.lit(routes.err.rstrip("/")))
    return outcomes.select(
        F.col("FILE_PATH").alias("SOURCE"),
        F.concat_ws("/", root, "SOURCE_DIR", "FILE_NAME").alias("TARGET"),
        "FILE_SIZE",
        F.unix_millis("MTIME").alias("MTIME_MS"),
    )


def write_journal(moves: DataFrame, folder: str, seq: int) -> None:
    moves.write.mode("overwrite").parquet(f"{folder}/seq={seq}")


def _is_loaded_file(spark: SparkSession, path: str, size: int, mtime_ms: int | None) -> bool:
    fs, p = FS.fs_path(spark, path)
    if not fs.exists(p):
        return False
    status = fs.getFileStatus(p)
    return status.getLen() == size and (mtime_ms is None or status.getModificationTime() == mtime_ms)


def replay(spark: SparkSession, folder: str, events: DataFrame) -> int:
    """Do the renames of every journal whose audit events are there; returns how many were done."""
    done = 0
    for name in [n for n in FS.names(spark, folder) if n.startswith("seq=")]:
        seq = int(name.split("=")[1])
        if not events.where(F.col("SEQ") == seq).isEmpty():
            for m in spark.read.schema(JOURNAL_SCHEMA).parquet(f"{folder}/{name}").toLocalIterator():
                if _is_loaded_file(spark, m["SOURCE"], m["FILE_SIZE"], m["MTIME_MS"]):
                    FS.delete_path(spark, m["TARGET"])  # an earlier file of that name
                    if not FS.rename(spark, m["SOURCE"], m["TARGET"]):
                        raise OSError(f"could not move {m['SOURCE']} to {m['TARGET']}")
                    done += 1
        FS.delete_path(spark, f"{folder}/{name}")
    return done
