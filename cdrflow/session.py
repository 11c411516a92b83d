"""Session settings the engine relies on.

The mapping compiles to one wide projection in which many output columns
(and the reject-reason array) derive from the same source columns.  Catalyst's
constraint propagation enumerates alias substitutions over such projections
and grows exponentially once a join sits above them, so the engine turns it
off; every filter it needs is written explicitly and still reaches the scan.

The same projection, fused into one generated method, is longer than what the
JVM compiles to machine code (8,000 bytes of bytecode) and would be interpreted
for good.  With the limit set to that size Spark generates smaller methods for
such a step instead: three times as fast on the OCC mapping.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the engine needs (idempotent)."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(
    app: str = "cdrflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine settings applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    return configure(spark)
