"""Per-file audit trail: append-only events and the derived current state.

The audit is keyed by (SOURCE_DIR, FILE_NAME, FILE_SIZE).  Instead of an
in-place upsert, every state change is appended as an event; the current row
of a file is the event with the highest sequence (``max_by``), an aggregate
that combines map-side, so a file with many events never lands whole in one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.mapping import AUDIT_MESSAGE_MAX, ERROR_CLASSES

AUDIT_KEYS = ["SOURCE_DIR", "FILE_NAME", "FILE_SIZE"]
AUDIT_COLUMNS = ["SOURCE_DIR", "FILE_NAME", "FILE_SIZE", "STATUS", "LOAD_TS", "MESSAGE", "ROWS_CSV", "ROWS_DB"]


def error_message(error_class: Column | str, detail: Column | str) -> Column:
    """``CLASS: detail`` cut to the audit message width."""
    ec = F.lit(error_class) if isinstance(error_class, str) else error_class
    d = F.lit(detail) if isinstance(detail, str) else detail
    return F.substring(F.concat_ws(": ", ec, d), 1, AUDIT_MESSAGE_MAX)


def success_message(tmp_rows, inserted, rejected) -> Column:
    """``TMP:n DETAIL:n REJECTED:n`` (parsed back by the reject-rate report)."""
    return F.format_string(
        "TMP:%d DETAIL:%d REJECTED:%d", F.col(tmp_rows), F.col(inserted), F.col(rejected)
    )


def audit_event(
    files: DataFrame,
    status: str | Column,
    load_ts: Column,
    message: Column | None = None,
    rows_csv: Column | None = None,
    rows_db: Column | None = None,
    seq: Column | int = 0,
) -> DataFrame:
    """One audit event per file row of ``files`` (must hold the audit keys)."""
    st = F.lit(status) if isinstance(status, str) else status
    sq = F.lit(seq) if isinstance(seq, int) else seq
    return files.select(
        F.col("SOURCE_DIR").cast(T.StringType()),
        F.col("FILE_NAME").cast(T.StringType()),
        F.col("FILE_SIZE").cast(T.LongType()),
        st.alias("STATUS"),
        load_ts.cast(T.TimestampNTZType()).alias("LOAD_TS"),
        F.substring(message, 1, AUDIT_MESSAGE_MAX).alias("MESSAGE")
        if message is not None
        else F.lit(None).cast(T.StringType()).alias("MESSAGE"),
        (rows_csv if rows_csv is not None else F.lit(None)).cast(T.LongType()).alias("ROWS_CSV"),
        (rows_db if rows_db is not None else F.lit(None)).cast(T.LongType()).alias("ROWS_DB"),
        sq.cast(T.LongType()).alias("SEQ"),
    )


def audit_latest(events: DataFrame) -> DataFrame:
    """Current audit row per file: the event with the highest (SEQ, LOAD_TS)."""
    payload = F.struct(*[F.col(c) for c in AUDIT_COLUMNS if c not in AUDIT_KEYS])
    order = F.struct(F.col("SEQ"), F.col("LOAD_TS"))
    return (
        events.groupBy(*AUDIT_KEYS)
        .agg(F.max_by(payload, order).alias("_CUR"))
        .select(*AUDIT_KEYS, "_CUR.*")
        .select(*AUDIT_COLUMNS)
    )


def error_class(message: Column | str = "MESSAGE") -> Column:
    m = F.col(message) if isinstance(message, str) else message
    return F.split_part(m, F.lit(":"), F.lit(1))


def error_classes(audit: DataFrame) -> DataFrame:
    """Files per error class (prefix of the message) among ERROR rows."""
    return (
        audit.where(F.col("STATUS") == "ERROR")
        .groupBy(error_class().alias("ERROR_CLASS"))
        .agg(F.count(F.lit(1)).alias("FILE_COUNT"))
    )


def _message_number(tag: str) -> Column:
    return F.nullif(F.regexp_extract(F.col("MESSAGE"), rf"{tag}:([0-9]+)", 1), F.lit("")).try_cast(T.LongType())


def parse_success_message(audit: DataFrame) -> DataFrame:
    """Typed TMP / DETAIL / REJECTED numbers of SUCCESS messages."""
    return audit.where(F.col("STATUS") == "SUCCESS").select(
        "SOURCE_DIR",
        "FILE_NAME",
        "FILE_SIZE",
        _message_number("TMP").alias("TMP_ROWS"),
        _message_number("DETAIL").alias("DETAIL_ROWS"),
        _message_number("REJECTED").alias("REJECTED_ROWS"),
    )


def file_outcome(steps: DataFrame, step_columns: list[str] | None = None) -> DataFrame:
    """First failing step wins; later steps are not run.

    ``steps`` has the audit keys and one nullable error-detail column per step,
    named after the error class (``DOWNLOAD_ERROR`` ... ``TRANSFORM_ERROR``).
    Returns STATUS, ERROR_CLASS and the audit MESSAGE of each file.
    """
    cols = step_columns or [c for c in ERROR_CLASSES if c in steps.columns]
    first = F.coalesce(
        *[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("cls"), F.col(c).cast("string").alias("detail")))
          for c in cols]
    )
    keys = [k for k in AUDIT_KEYS if k in steps.columns]
    return steps.select(*keys, first.alias("_E")).select(
        *keys,
        F.when(F.col("_E").isNull(), F.lit("SUCCESS")).otherwise(F.lit("ERROR")).alias("STATUS"),
        F.col("_E.cls").alias("ERROR_CLASS"),
        F.when(F.col("_E").isNotNull(), error_message(F.col("_E.cls"), F.col("_E.detail"))).alias("MESSAGE"),
    )
