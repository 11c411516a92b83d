"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as a Java / SQL character class; words are runs of anything else.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def ship(module: str) -> None:
    """Send a module's functions to the Python workers by value, so that they need not be able to import it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share (``spark.checkpoint.dir``).

    Only on one machine, where the session names none (tests), a fresh
    temporary folder is set as the session's checkpoint folder.  On a cluster
    executors could not share that, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cdrflow-shared-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/cdrflow/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    This cuts the lineage at a point that survives the loss of an executor,
    freezes generated row ids, and gives the optimizer the true size.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def other_columns(names: list[str], added: list[str] | tuple[str, ...]) -> list[str]:
    """Those of ``names`` that no added column takes the place of; case does not matter, as in Spark."""
    taken = {a.lower() for a in added}
    return [c for c in names if c.lower() not in taken]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is.

    For pure ASCII text ``lower`` does just that and is much faster than
    ``translate``, which looks up every character.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))
