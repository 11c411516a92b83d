"""Registered maintenance queries: skip-loaded, reload, cleanup, orphans,
cleanup strategy, audit retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.operators import maintain as MT
from cdrflow.plans import fixtures as FX
from cdrflow.plans import oracle_sql as O
from cdrflow.plans.registry import register

AS_OF = FX.AS_OF
STG_COLS = ["SOURCE_DIR", "SOURCE_FILE", "LOAD_TS"]


def staging_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.cdr_raw(spark, sf_dir).select(*STG_COLS).unionByName(FX.staging_mmg(spark, sf_dir).select(*STG_COLS))


def _actions(keep: DataFrame, drop: DataFrame) -> DataFrame:
    both = keep.withColumn("ACTION", F.lit("KEEP")).unionByName(drop.withColumn("ACTION", F.lit("DROP")))
    return both.groupBy("SOURCE_DIR", "SOURCE_FILE", "ACTION").agg(F.count(F.lit(1)).alias("ROWS"))


_BASE = (
    "WITH cdr_raw AS (" + O.CDR_RAW + "), staging_mmg AS (" + O.STAGING_MMG + "), load_audit AS ("
    + O.LOAD_AUDIT + "), staging_all AS (SELECT SOURCE_DIR, SOURCE_FILE, LOAD_TS FROM cdr_raw "
    "UNION ALL SELECT SOURCE_DIR, SOURCE_FILE, LOAD_TS FROM staging_mmg) "
)
_OK = (
    "EXISTS (SELECT 1 FROM load_audit a WHERE a.STATUS = 'SUCCESS' AND a.SOURCE_DIR = s.SOURCE_DIR "
    "AND a.FILE_NAME = s.SOURCE_FILE{extra})"
)

register(
    "staging_cleanup",
    _BASE + "SELECT SOURCE_DIR, SOURCE_FILE, CASE WHEN " + _OK.format(extra="")
    + " THEN 'DROP' ELSE 'KEEP' END AS ACTION, COUNT(*) AS ROWS FROM staging_all s GROUP BY ALL",
)(lambda spark, d: _actions(*MT.cleanup(staging_all(spark, d), FX.load_audit(spark, d))))

register(
    "staging_orphans",
    _BASE + "SELECT SOURCE_DIR, SOURCE_FILE, CASE WHEN NOT "
    + _OK.format(extra=f" AND a.LOAD_TS >= {O.AS_OF} - INTERVAL 24 HOUR")
    + f" AND s.LOAD_TS < {O.AS_OF} - INTERVAL 24 HOUR THEN 'DROP' ELSE 'KEEP' END AS ACTION, COUNT(*) AS ROWS "
    "FROM staging_all s GROUP BY ALL",
)(lambda spark, d: _actions(*MT.orphans(staging_all(spark, d), FX.load_audit(spark, d), AS_OF, 24)))

_STRATS = ("on_success", "on_error", "never")


@register(
    "cleanup_strategy",
    _BASE + " UNION ALL ".join(
        f"SELECT '{st}' AS STRATEGY, SOURCE_DIR, SOURCE_FILE, COUNT(*) AS ROWS_DROPPED FROM staging_all s WHERE "
        + ("FALSE" if st == "never" else
           f"EXISTS (SELECT 1 FROM load_audit a WHERE a.STATUS = '{'SUCCESS' if st == 'on_success' else 'ERROR'}' "
           "AND a.SOURCE_DIR = s.SOURCE_DIR AND a.FILE_NAME = s.SOURCE_FILE)")
        + " GROUP BY ALL"
        for st in _STRATS
    ),
)
def q_cleanup_strategy(spark, sf_dir):
    stg = staging_all(spark, sf_dir)
    outcomes = FX.load_audit(spark, sf_dir).select("SOURCE_DIR", F.col("FILE_NAME").alias("SOURCE_FILE"), "STATUS")
    parts = [
        stg.join(MT.cleanup_files(outcomes, st), MT.STAGING_KEYS, "left_semi")
        .groupBy("SOURCE_DIR", "SOURCE_FILE")
        .agg(F.count(F.lit(1)).alias("ROWS_DROPPED"))
        .select(F.lit(st).alias("STRATEGY"), "SOURCE_DIR", "SOURCE_FILE", "ROWS_DROPPED")
        for st in _STRATS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _archive_sql(days: int) -> str:
    return (
        "WITH load_audit AS (" + O.LOAD_AUDIT + ") SELECT STATUS, CASE WHEN LOAD_TS < "
        + O.AS_OF + f" - INTERVAL {days} DAY THEN 'DROP' ELSE 'KEEP' END AS ACTION, COUNT(*) AS FILES "
        "FROM load_audit GROUP BY ALL"
    )


def _archive(spark, sf_dir, days: int) -> DataFrame:
    keep, drop = MT.retain(FX.load_audit(spark, sf_dir), AS_OF, days)
    both = keep.withColumn("ACTION", F.lit("KEEP")).unionByName(drop.withColumn("ACTION", F.lit("DROP")))
    return both.groupBy("STATUS", "ACTION").agg(F.count(F.lit(1)).alias("FILES"))


register("audit_archive", _archive_sql(90))(lambda spark, d: _archive(spark, d, 90))
# the audit fixture spans 30 days: with 14 there are rows to drop
register("audit_archive_14d", _archive_sql(14))(lambda spark, d: _archive(spark, d, 14))


def listing(spark, sf_dir) -> DataFrame:
    """Landing listing derived from the orders: every 10th file changed size."""
    o = FX.load_audit(spark, sf_dir)
    k = F.regexp_extract("FILE_NAME", r"_([0-9]+)\.csv", 1).cast("bigint")
    return o.select("SOURCE_DIR", "FILE_NAME",
                    (F.col("FILE_SIZE") + F.when(k % 10 == 0, F.lit(1)).otherwise(F.lit(0))).alias("FILE_SIZE"))


register(
    "skip_loaded_files",
    "WITH load_audit AS (" + O.LOAD_AUDIT + "), listing AS (SELECT SOURCE_DIR, FILE_NAME, FILE_SIZE + "
    "CASE WHEN CAST(regexp_extract(FILE_NAME, '_([0-9]+)\\.csv', 1) AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END AS FILE_SIZE "
    "FROM load_audit) SELECT * FROM listing l WHERE NOT EXISTS (SELECT 1 FROM load_audit a WHERE a.STATUS = 'SUCCESS' "
    "AND a.SOURCE_DIR = l.SOURCE_DIR AND a.FILE_NAME = l.FILE_NAME AND a.FILE_SIZE = l.FILE_SIZE)",
)(lambda spark, d: MT.skip_loaded(listing(spark, d), FX.load_audit(spark, d)))


@register(
    "staging_reload",
    "WITH cdr_raw AS (" + O.CDR_RAW + "), stg AS (SELECT SOURCE_DIR, SOURCE_FILE, LOAD_TS FROM cdr_raw "
    "WHERE SOURCE_LINE % 20 NOT IN (3, 4) UNION ALL SELECT SOURCE_DIR, SOURCE_FILE, " + O.AS_OF
    + " FROM cdr_raw WHERE SOURCE_LINE % 40 IN (3, 4)) SELECT SOURCE_DIR, SOURCE_FILE, COUNT(*) AS ROWS, "
    "MAX(LOAD_TS) AS LAST_LOAD FROM stg GROUP BY ALL",
)
def q_staging_reload(spark, sf_dir):
    raw = FX.cdr_raw(spark, sf_dir)
    stg = raw.select("SOURCE_DIR", "SOURCE_FILE", "LOAD_TS")
    new = raw.where(F.col("SOURCE_LINE") % 40 < 5).where(F.col("SOURCE_LINE") % 40 > 2).select(
        "SOURCE_DIR", "SOURCE_FILE", FX.ntz(AS_OF).alias("LOAD_TS"))
    return MT.reload(stg, new).groupBy("SOURCE_DIR", "SOURCE_FILE").agg(
        F.count(F.lit(1)).alias("ROWS"), F.max("LOAD_TS").alias("LAST_LOAD"))


@register(
    "staging_reload_versions",
    "WITH cdr_raw AS (" + O.CDR_RAW + ") SELECT SOURCE_DIR, SOURCE_FILE, COUNT(*) AS ROWS, MIN(SOURCE_LINE) AS FIRST_LINE "
    "FROM cdr_raw WHERE CASE WHEN SOURCE_FILE IN ('CDR_OCC_04.csv', 'CDR_OCC_06.csv') THEN FALSE "
    "WHEN SOURCE_FILE = 'CDR_OCC_08.csv' THEN SOURCE_LINE % 40 < 10 ELSE TRUE END GROUP BY ALL",
)
def q_staging_reload_versions(spark, sf_dir):
    """Of three files loaded again one has become empty, one has fewer rows, one is dropped afterwards."""
    raw = FX.cdr_raw(spark, sf_dir).select("SOURCE_DIR", "SOURCE_FILE", "SOURCE_LINE")
    again = raw.where((F.col("SOURCE_FILE") == "CDR_OCC_08.csv") & (F.col("SOURCE_LINE") % 40 < 10))
    again = again.unionByName(raw.where((F.col("SOURCE_FILE") == "CDR_OCC_06.csv") & (F.col("SOURCE_LINE") % 20 < 9)))
    rows = raw.withColumn("LOAD", F.lit(1)).unionByName(again.withColumn("LOAD", F.lit(2)))
    files = raw.select("SOURCE_DIR", "SOURCE_FILE").distinct()

    def lines(where, load, dropped):
        return files.where(where).withColumns({"LOAD": F.lit(load), "DROPPED": F.lit(dropped)})

    name = F.col("SOURCE_FILE")
    versions = lines(F.lit(True), 1, False)
    versions = versions.unionByName(lines(name.isin("CDR_OCC_04.csv", "CDR_OCC_06.csv", "CDR_OCC_08.csv"), 2, False))
    versions = versions.unionByName(lines(name == "CDR_OCC_06.csv", 2, True))
    return MT.current_rows(rows, versions).groupBy("SOURCE_DIR", "SOURCE_FILE").agg(
        F.count(F.lit(1)).alias("ROWS"), F.min("SOURCE_LINE").alias("FIRST_LINE"))
