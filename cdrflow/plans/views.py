"""The recent-detail view and the dashboard by name: SQL table functions that take the time they speak of.

    SELECT * FROM cdr_recent(TIMESTAMP_NTZ'2024-01-31 00:00:00', 30)
    SELECT * FROM cdr_dashboard(TIMESTAMP_NTZ'2024-01-31 00:00:00')

They read the session's views ``cdr_audit``, ``cdr_staging_occ``,
``cdr_staging_mmg`` and ``cdr_detail``; a consumer sorts what it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _returns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def register_views(spark: SparkSession, audit: DataFrame, staging_occ: DataFrame, staging_mmg: DataFrame, detail: DataFrame) -> None:
    """Create or replace the four temporary views and the two temporary functions over them."""
    for name, df in (("audit", audit), ("staging_occ", staging_occ), ("staging_mmg", staging_mmg), ("detail", detail)):
        df.createOrReplaceTempView(f"cdr_{name}")
    since = "date_sub(CAST(as_of AS DATE), days)"
    pruned = f" AND START_DAY >= {since}" if "START_DAY" in detail.columns else ""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION cdr_recent(as_of TIMESTAMP_NTZ, days INT DEFAULT 30) RETURNS TABLE ({_returns(detail)}) "
        f"RETURN SELECT * FROM cdr_detail WHERE START_DATE >= CAST({since} AS TIMESTAMP_NTZ){pruned}"
    )
    columns = ("FILES_24H", "FILES_SUCCESS_24H", "FILES_ERROR_24H", "ROWS_PROCESSED_24H", "TMP_OCC_ROWS", "TMP_MMG_ROWS",
               "DETAIL_OCC_TODAY", "DETAIL_OCC_TOTAL")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION cdr_dashboard(as_of TIMESTAMP_NTZ) RETURNS TABLE ("
        + ", ".join(f"{c} BIGINT" for c in columns)
        + ") RETURN SELECT a.FILES_24H, a.FILES_SUCCESS_24H, a.FILES_ERROR_24H, a.ROWS_PROCESSED_24H, o.N, m.N, d.TODAY, d.N FROM "
        "(SELECT count(*) AS FILES_24H, count_if(STATUS = 'SUCCESS') AS FILES_SUCCESS_24H, count_if(STATUS = 'ERROR') AS FILES_ERROR_24H, "
        "sum(ROWS_CSV) FILTER (WHERE STATUS = 'SUCCESS') AS ROWS_PROCESSED_24H FROM cdr_audit WHERE LOAD_TS >= as_of - INTERVAL 1 DAY) a "
        "CROSS JOIN (SELECT count(*) AS N FROM cdr_staging_occ) o CROSS JOIN (SELECT count(*) AS N FROM cdr_staging_mmg) m "
        "CROSS JOIN (SELECT count(*) AS N, count_if(START_DATE >= SINCE) AS TODAY FROM "
        "(SELECT START_DATE, CAST(CAST(as_of AS DATE) AS TIMESTAMP_NTZ) AS SINCE FROM cdr_detail)) d"
    )
