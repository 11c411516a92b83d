"""Declarative column mapping: CSV/staging column -> typed detail column.

The mapping is the only user extension point of the engine.  It is compiled
into one list of Spark ``Column`` expressions (``operators.transform``) so the
whole staging -> detail step is a single projection planned by Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    """One mapping entry.

    ``target`` is the detail column (``None``: used for de-duplication only).
    ``kind`` is ``string`` | ``number`` | ``timestamp``.
    ``transform`` is ``trim`` | ``upper`` | ``clean_msisdn`` | ``None``.
    ``precision``/``scale`` give the detail decimal type of a number column.
    ``extra`` is an optional user function ``Column -> Column`` applied after
    the named transform (the mapping's extension hook; JVM-side only).
    """

    source: str
    target: str | None
    required: bool = False
    kind: str = "string"
    transform: str | None = None
    max_length: int | None = None
    default: str | None = None
    precision: int | None = None
    scale: int | None = None
    extra: Callable[[Column], Column] | None = field(default=None, compare=False)


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference configuration and DDL
# (OCC feed: 25 mapping entries, order as configured; decimal precision and
# scale of the number columns from the detail table definition).
# ---------------------------------------------------------------------------
OCC_MAPPING: tuple[ColumnSpec, ...] = (
    ColumnSpec("DATASOURCE", "DATASOURCE", True, "string", "trim", 20),
    ColumnSpec("A_MSISDN", "A_MSISDN", True, "string", "clean_msisdn", 200),
    ColumnSpec("B_MSISDN", "B_MSISDN", False, "string", "clean_msisdn", 200),
    ColumnSpec("ORIG_START_TIME", "START_DATE", True, "timestamp", "trim"),
    ColumnSpec("APN", "APN", True, "string", "trim", 50),
    ColumnSpec("CALL_TYPE", "CALL_TYPE", True, "string", "upper", 20),
    ColumnSpec("EVENT_TYPE", "EVENT_TYPE", True, "string", "upper", 20),
    ColumnSpec("CHARGING_ID", "CHARGING_ID", True, "string", "trim", 40),
    ColumnSpec("SERVICE_ID", "SERVICE_ID", True, "string", "trim", 40),
    ColumnSpec("SUBSCRIBER_TYPE", "SUBSCRIBER_TYPE", True, "string", "trim", 30),
    ColumnSpec("ROAMING_TYPE", "ROAMING_TYPE", True, "string", "trim", 10),
    ColumnSpec("PARTNER", "PARTNER", True, "string", "trim", 20),
    ColumnSpec("FILTER_CODE", "FILTER_CODE", True, "string", "trim", 20),
    ColumnSpec("FLEX_FLD1", "FLEX_FLD1", True, "string", "trim", 100),
    ColumnSpec("FLEX_FLD2", "FLEX_FLD2", True, "string", "trim", 100),
    ColumnSpec("FLEX_FLD3", "FLEX_FLD3", True, "string", "trim", 100),
    ColumnSpec("EVENT_COUNT", "EVENT_COUNT", False, "number", precision=30, scale=0),
    ColumnSpec("DATA_VOLUME", "DATA_VOLUME", False, "number", precision=30, scale=5),
    ColumnSpec("EVENT_DURATION", "EVENT_DURATION", False, "number", precision=30, scale=0),
    ColumnSpec("CHARGE_AMOUNT", "CHARGE_AMOUNT", False, "number", precision=20, scale=5),
    ColumnSpec("DA_AMOUNT_CALC", "DA_AMOUNT_CALC", False, "number", precision=20, scale=5),
    ColumnSpec("MA_AMNT_CALC", "MA_AMNT_CALC", False, "number", precision=20, scale=5),
    ColumnSpec("KEYWORD", "KEYWORD", False, "string", "trim", 100, default="_N"),
    ColumnSpec("CALL_REFERENCE", None, False, "string", "trim"),
    ColumnSpec("RECORD_ID", None, False, "string", "trim"),
)

# De-duplication keys in priority order (first non-blank wins).
OCC_DEDUP_KEYS: tuple[str, ...] = ("CHARGING_ID", "CALL_REFERENCE", "RECORD_ID")

# The MMG feed has no mapping yet: it can be staged but not transformed.
MMG_MAPPING: tuple[ColumnSpec, ...] = ()
MMG_DEDUP_KEYS: tuple[str, ...] = ()

# Technical columns added to every staging row.
TECHNICAL_COLUMNS: tuple[str, ...] = ("SOURCE_FILE", "SOURCE_DIR", "LOAD_TS")

# Feed -> (staging table, detail table) names.
TABLES = {
    "OCC": ("RA_T_TMP_OCC", "RA_T_OCC_CDR_DETAIL"),
    "MMG": ("RA_T_TMP_MMG", "RA_T_MMG_CDR_DETAIL"),
}

MAPPINGS = {"OCC": OCC_MAPPING, "MMG": MMG_MAPPING}
DEDUP_KEYS = {"OCC": OCC_DEDUP_KEYS, "MMG": MMG_DEDUP_KEYS}

TIMESTAMP_UNITS = ("seconds", "milliseconds")
CLEANUP_STRATEGIES = ("on_success", "on_error", "never")
WHITELIST_MODES = ("dynamic", "permissive", "strict")
DUPLICATE_POLICIES = ("fail_file", "keep_first")

# Audit statuses and error classes (message prefixes), in load-step order.
STATUS_DOWNLOADED, STATUS_SUCCESS, STATUS_ERROR = "DOWNLOADED", "SUCCESS", "ERROR"
ERROR_CLASSES = (
    "DOWNLOAD_ERROR",
    "COPY_ERROR",
    "CSV_INVALID",
    "WHITELIST_ERROR",
    "DDL_ERROR",
    "LOAD_ERROR",
    "TRANSFORM_ERROR",
)
AUDIT_MESSAGE_MAX = 4000
COLUMN_NAME_MAX = 30


def detail_columns(mapping) -> list[str]:
    """Detail column order: mapped targets, then START_HOUR, ORIG_START_TIME."""
    cols = [s.target for s in mapping if s.target is not None]
    cols.append("START_HOUR")
    if "ORIG_START_TIME" not in cols:
        cols.append("ORIG_START_TIME")
    return cols


def detail_type(spec: ColumnSpec) -> T.DataType:
    if spec.kind == "number":
        return T.DecimalType(spec.precision or 38, spec.scale or 0)
    if spec.kind == "timestamp":
        return T.TimestampNTZType()
    return T.StringType()


def detail_schema(mapping=OCC_MAPPING) -> T.StructType:
    """Typed detail schema (25 columns for OCC)."""
    fields = []
    for s in mapping:
        if s.target is None:
            continue
        fields.append(T.StructField(s.target, detail_type(s), not s.required))
    fields.append(T.StructField("START_HOUR", T.IntegerType(), True))
    if "ORIG_START_TIME" not in [f.name for f in fields]:
        fields.append(T.StructField("ORIG_START_TIME", T.StringType(), True))
    return T.StructType(fields)


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("SOURCE_DIR", T.StringType(), True),
        T.StructField("FILE_NAME", T.StringType(), True),
        T.StructField("FILE_SIZE", T.LongType(), True),
        T.StructField("STATUS", T.StringType(), True),
        T.StructField("LOAD_TS", T.TimestampNTZType(), True),
        T.StructField("MESSAGE", T.StringType(), True),
        T.StructField("ROWS_CSV", T.LongType(), True),
        T.StructField("ROWS_DB", T.LongType(), True),
    ]
)
