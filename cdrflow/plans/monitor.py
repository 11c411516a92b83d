"""Monitoring and data-quality pack over the audit, staging and detail tables.

Every query takes an explicit ``as_of`` (``'YYYY-MM-DD HH:MM:SS'``) instead of
the wall clock.  Day-equality filters are written as ranges on the raw column
so they reach the parquet scan (and the START_DAY partition filter is added
when the detail table is day-partitioned); repeated scalar subqueries are
fused into one conditional aggregate per table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.functions.cleaning import MSISDN_CHARS_PATTERN, ntz

FMT = "yyyy-MM-dd HH:mm:ss"


def _parse(as_of: str) -> dt.datetime:
    return dt.datetime.fromisoformat(as_of)


def _day(as_of: str, minus_days: int = 0) -> str:
    d = _parse(as_of).date() - dt.timedelta(days=minus_days)
    return f"{d.isoformat()} 00:00:00"


def _minus(as_of: str, days: int = 0, hours: int = 0) -> str:
    return (_parse(as_of) - dt.timedelta(days=days, hours=hours)).strftime("%Y-%m-%d %H:%M:%S")


def pct2(num: Column, den: Column) -> Column:
    """round(100 * num / den, 2), half away from zero, exact; NULL when den = 0."""
    n, d = num.cast("bigint"), F.nullif(den.cast("bigint"), F.lit(0))
    cents = F.call_function("div", F.lit(20000) * F.abs(n) + d, F.lit(2) * d)  # whole numbers throughout
    return (F.signum(n) * cents / F.lit(100.0)).cast(T.DoubleType())


def round2(c: Column) -> Column:
    """Round a decimal half away from zero to 2 places, report as DOUBLE."""
    return F.round(c, 2).cast(T.DoubleType())


def _day_range(df: DataFrame, col: str, lo: str, hi: str | None = None) -> DataFrame:
    """Range filter on a timestamp column (+ partition filter on START_DAY)."""
    cond = F.col(col) >= ntz(lo)
    if hi is not None:
        cond = cond & (F.col(col) < ntz(hi))
    if "START_DAY" in df.columns and col == "START_DATE":
        dcond = F.col("START_DAY") >= F.lit(lo[:10]).cast(T.DateType())
        if hi is not None:
            dcond = dcond & (F.col("START_DAY") < F.lit(hi[:10]).cast(T.DateType()))
        cond = cond & dcond
    return df.where(cond)


# --------------------------------------------------------------------------
# Audit
# --------------------------------------------------------------------------
def m_recent_loads(audit: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    return (
        audit.where(F.col("LOAD_TS") >= ntz(_minus(as_of, hours=hours)))
        .orderBy(F.col("LOAD_TS").desc_nulls_first(), "FILE_NAME", "SOURCE_DIR")
        .select(
            "SOURCE_DIR",
            "FILE_NAME",
            "STATUS",
            F.col("ROWS_CSV").cast("bigint").alias("ROWS_CSV"),
            F.substring("MESSAGE", 1, 100).alias("MESSAGE_SHORT"),
            F.date_format("LOAD_TS", FMT).alias("LOAD_TIME"),
        )
    )


def m_status_today(audit: DataFrame, day: str) -> DataFrame:
    lo = f"{day[:10]} 00:00:00"
    hi = _day(lo, -1)
    return (
        audit.where((F.col("LOAD_TS") >= ntz(lo)) & (F.col("LOAD_TS") < ntz(hi)))
        .groupBy("STATUS")
        .agg(F.count(F.lit(1)).alias("FILE_COUNT"), F.sum("ROWS_CSV").cast("bigint").alias("TOTAL_ROWS"))
        .orderBy("STATUS")
    )


def m_success_rate(audit: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    ok = F.sum(F.when(F.col("STATUS") == "SUCCESS", 1).otherwise(0))
    return (
        audit.where(F.col("LOAD_TS") >= ntz(_minus(as_of, days=days)))
        .groupBy("SOURCE_DIR")
        .agg(F.count(F.lit(1)).alias("TOTAL_FILES"), ok.cast("bigint").alias("SUCCESS_COUNT"))
        .select("SOURCE_DIR", "TOTAL_FILES", "SUCCESS_COUNT",
                pct2(F.col("SUCCESS_COUNT"), F.col("TOTAL_FILES")).alias("SUCCESS_RATE_PCT"))
        .orderBy("SOURCE_DIR")
    )


def m_last_errors(audit: DataFrame, limit: int = 20) -> DataFrame:
    return (
        audit.where(F.col("STATUS") == "ERROR")
        .orderBy(F.col("LOAD_TS").desc_nulls_first(), "FILE_NAME", "SOURCE_DIR", "FILE_SIZE")
        .limit(limit)
        .select("FILE_NAME", "SOURCE_DIR", F.date_format("LOAD_TS", FMT).alias("ERROR_TIME"), "MESSAGE")
    )


def _msg_num(tag: str) -> Column:
    return F.nullif(F.regexp_extract("MESSAGE", rf"{tag}:([0-9]+)", 1), F.lit("")).try_cast("bigint")


def m_reject_rate(audit: DataFrame, as_of: str, days: int = 7, limit: int = 20) -> DataFrame:
    parsed = audit.where(
        (F.col("STATUS") == "SUCCESS") & (F.col("LOAD_TS") >= ntz(_minus(as_of, days=days)))
    ).select(
        "FILE_NAME",
        "SOURCE_DIR",
        "FILE_SIZE",
        F.date_format("LOAD_TS", FMT).alias("LOAD_TIME"),
        _msg_num("TMP").alias("TMP_ROWS"),
        _msg_num("DETAIL").alias("DETAIL_ROWS"),
        _msg_num("REJECTED").alias("REJECTED_ROWS"),
    )
    return (
        parsed.withColumn("REJECT_RATE_PCT", pct2(F.col("REJECTED_ROWS"), F.col("TMP_ROWS")))
        .orderBy(F.col("REJECT_RATE_PCT").desc_nulls_last(), "FILE_NAME", "SOURCE_DIR", "FILE_SIZE")
        .limit(limit)
        .select("FILE_NAME", "LOAD_TIME", "TMP_ROWS", "DETAIL_ROWS", "REJECTED_ROWS", "REJECT_RATE_PCT")
    )


# --------------------------------------------------------------------------
# Staging
# --------------------------------------------------------------------------
def m_staging_counts(staging: dict[str, DataFrame]) -> DataFrame:
    """Rows and distinct files per staging table (one row even when empty)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("ROW_COUNT"), F.count_distinct("SOURCE_FILE").alias("FILE_COUNT"))
        .select(F.lit(name).alias("TABLE_NAME"), "ROW_COUNT", "FILE_COUNT")
        for name, df in staging.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def m_staging_files(staging: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.groupBy("SOURCE_FILE")
        .agg(F.count(F.lit(1)).alias("ROW_COUNT"), F.min("LOAD_TS").alias("FIRST_LOAD"), F.max("LOAD_TS").alias("LAST_LOAD"))
        .select(F.lit(kind).alias("SOURCE_TYPE"), "SOURCE_FILE", "ROW_COUNT", "FIRST_LOAD", "LAST_LOAD")
        for kind, df in staging.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.col("LAST_LOAD").desc_nulls_first(), "SOURCE_TYPE", "SOURCE_FILE")


# --------------------------------------------------------------------------
# Detail
# --------------------------------------------------------------------------
def m_daily_volume(detail: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return (
        _day_range(detail, "START_DATE", _day(as_of, days))
        .groupBy(F.col("START_DATE").cast(T.DateType()).alias("DATE_JOUR"))
        .agg(
            F.count(F.lit(1)).alias("TOTAL_EVENTS"),
            F.sum("DATA_VOLUME").cast(T.DoubleType()).alias("TOTAL_DATA_MB"),
            round2(F.avg("CHARGE_AMOUNT")).alias("AVG_CHARGE"),
        )
        .orderBy(F.col("DATE_JOUR").desc())
    )


def m_top_msisdn(detail: DataFrame, as_of: str, days: int = 7, limit: int = 10) -> DataFrame:
    return (
        _day_range(detail, "START_DATE", _day(as_of, days))
        .groupBy("A_MSISDN")
        .agg(
            F.count(F.lit(1)).alias("EVENT_COUNT"),
            round2(F.sum("DATA_VOLUME")).alias("TOTAL_DATA_MB"),
            round2(F.sum("CHARGE_AMOUNT")).alias("TOTAL_CHARGE"),
        )
        .orderBy(F.col("TOTAL_DATA_MB").desc_nulls_first(), F.col("A_MSISDN").asc_nulls_last())
        .limit(limit)
    )


def m_event_mix(detail: DataFrame, day: str) -> DataFrame:
    lo = f"{day[:10]} 00:00:00"
    return (
        _day_range(detail, "START_DATE", lo, _day(lo, -1))
        .groupBy("EVENT_TYPE", "CALL_TYPE")
        .agg(F.count(F.lit(1)).alias("EVENT_COUNT"), round2(F.sum("DATA_VOLUME")).alias("TOTAL_DATA_MB"))
        .orderBy(F.col("EVENT_COUNT").desc(), "EVENT_TYPE", "CALL_TYPE")
    )


def m_hourly(detail: DataFrame, day: str) -> DataFrame:
    lo = f"{day[:10]} 00:00:00"
    return (
        _day_range(detail, "START_DATE", lo, _day(lo, -1))
        .groupBy("START_HOUR")
        .agg(F.count(F.lit(1)).alias("EVENT_COUNT"), round2(F.avg("DATA_VOLUME")).alias("AVG_DATA_MB"))
        .orderBy("START_HOUR")
    )


def m_null_profile(detail: DataFrame, as_of: str, days: int = 1,
                   columns: tuple[str, ...] = ("B_MSISDN", "EVENT_COUNT", "DATA_VOLUME")) -> DataFrame:
    """NULL count and % per column in one aggregate pass, then unpivoted."""
    agg = _day_range(detail, "START_DATE", _day(as_of, days)).agg(
        F.count(F.lit(1)).alias("_N"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = agg.selectExpr("_N", f"stack({len(columns)}, {stack}) AS (COLUMN_NAME, NULL_COUNT)")
    return long.select(
        "COLUMN_NAME",
        F.col("NULL_COUNT").cast("bigint").alias("NULL_COUNT"),
        pct2(F.col("NULL_COUNT"), F.col("_N")).alias("NULL_PCT"),
    )


def m_dup_keys(detail: DataFrame, key: str = "CHARGING_ID") -> DataFrame:
    return (
        detail.groupBy(key)
        .agg(F.count(F.lit(1)).alias("DUPLICATE_COUNT"))
        .where(F.col("DUPLICATE_COUNT") > 1)
        .orderBy(F.col("DUPLICATE_COUNT").desc(), key)
    )


def m_bad_msisdn(detail: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    bad = (F.length("A_MSISDN") < 8) | ~F.regexp_like(F.col("A_MSISDN"), F.lit(MSISDN_CHARS_PATTERN))
    return (
        _day_range(detail, "START_DATE", _day(as_of, days))
        .where(bad)
        .groupBy("A_MSISDN")
        .agg(F.count(F.lit(1)).alias("EVENT_COUNT"))
        .orderBy(F.col("EVENT_COUNT").desc(), "A_MSISDN")
    )


def v_recent(detail: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """The detail rows of the last days, in no order: a global sort of all of them would shuffle every column.

    ``newest_first`` is for the part that a consumer shows.
    """
    return _day_range(detail, "START_DATE", _day(as_of, days))


def newest_first(detail: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest rows first, equal times by key; with ``limit`` each task keeps only so many rows."""
    ordered = detail.orderBy(F.col("START_DATE").desc_nulls_last(), F.col("CHARGING_ID").asc_nulls_last())
    return ordered if limit is None else ordered.limit(limit)


def table_volume(df: DataFrame) -> DataFrame:
    """Bytes on storage of a file-based table: its files are listed, no row is read."""
    spark = df.sparkSession
    paths = df.inputFiles()
    listed = spark.createDataFrame([(p,) for p in paths], "p string")
    sizes = spark.read.format("binaryFile").load(paths).select(F.col("length").alias("s")) if paths else listed.select(F.lit(0).cast("bigint").alias("s"))
    return sizes.agg(
        F.count(F.lit(1)).alias("FILES"),
        F.sum("s").cast("bigint").alias("BYTES"),
        F.round(F.sum("s") / F.lit(1024 * 1024), 2).alias("SIZE_MB"),
        F.round(F.sum("s") / F.lit(1024 * 1024 * 1024), 2).alias("SIZE_GB"),
    )


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, files and average text row length (bytes of the string columns)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "SOURCE_FILE"]
    row_len = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in strings), F.lit(0))
    agg = df.agg(
        F.count(F.lit(1)).alias("ROW_COUNT"),
        F.count_distinct("SOURCE_FILE").alias("FILE_COUNT"),
        F.sum(row_len).cast("bigint").alias("_LEN"),
    )
    avg = F.floor((F.lit(200) * F.col("_LEN") + F.col("ROW_COUNT")) / (F.lit(2) * F.nullif(F.col("ROW_COUNT"), F.lit(0))))
    return agg.select(
        F.lit(name).alias("TABLE_NAME"),
        "ROW_COUNT",
        "FILE_COUNT",
        (avg.cast("bigint") / F.lit(100.0)).cast(T.DoubleType()).alias("AVG_ROW_LEN"),
    )


def v_dashboard(audit: DataFrame, staging_occ: DataFrame, staging_mmg: DataFrame,
                detail: DataFrame, as_of: str) -> DataFrame:
    """Eight scalars in one row: one conditional aggregate per table."""
    since = ntz(_minus(as_of, days=1))
    recent = F.col("LOAD_TS") >= since
    a = audit.agg(
        F.count_if(recent).alias("FILES_24H"),
        F.count_if(recent & (F.col("STATUS") == "SUCCESS")).alias("FILES_SUCCESS_24H"),
        F.count_if(recent & (F.col("STATUS") == "ERROR")).alias("FILES_ERROR_24H"),
        F.sum(F.when(recent & (F.col("STATUS") == "SUCCESS"), F.col("ROWS_CSV"))).cast("bigint").alias("ROWS_PROCESSED_24H"),
    )
    t1 = staging_occ.agg(F.count(F.lit(1)).alias("TMP_OCC_ROWS"))
    t2 = staging_mmg.agg(F.count(F.lit(1)).alias("TMP_MMG_ROWS"))
    d = detail.agg(
        F.count_if(F.col("START_DATE") >= ntz(_day(as_of))).alias("DETAIL_OCC_TODAY"),
        F.count(F.lit(1)).alias("DETAIL_OCC_TOTAL"),
    )
    cols = ["FILES_24H", "FILES_SUCCESS_24H", "FILES_ERROR_24H", "ROWS_PROCESSED_24H",
            "TMP_OCC_ROWS", "TMP_MMG_ROWS", "DETAIL_OCC_TODAY", "DETAIL_OCC_TOTAL"]
    one = a.unionByName(t1, allowMissingColumns=True).unionByName(t2, allowMissingColumns=True)
    one = one.unionByName(d, allowMissingColumns=True)
    # Four one-row frames -> one row; max() picks each frame's only value.
    return one.agg(*[F.max(c).cast("bigint").alias(c) for c in cols])
