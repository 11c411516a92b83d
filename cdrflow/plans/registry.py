"""Registered queries (Spark) and their DuckDB oracles.

Each query reads the driver tables under ``sf_dir`` (through the fixtures of
``plans.fixtures``) and runs the engine operators on the whole tables.
Decimal outputs are reported as DOUBLE on both engines.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.session import configure
from cdrflow.mapping import OCC_DEDUP_KEYS, OCC_MAPPING, ColumnSpec, detail_schema
from cdrflow.operators import audit as A
from cdrflow.operators import merge as MG
from cdrflow.operators import sketches as SK
from cdrflow.operators import transform as TR
from cdrflow.plans import fixtures as FX
from cdrflow.plans import monitor as M
from cdrflow.plans import oracle_sql as O
from cdrflow.plans.views import register_views
from cdrflow.sources import tables as TB

AS_OF = FX.AS_OF
TODAY = FX.TODAY
DECIMALS = sorted(O.DECIMAL_COLS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _as_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(T.DoubleType()).alias(c) if c in DECIMALS else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------
# Shared Spark building blocks (whole tables, no sampling)
# --------------------------------------------------------------------------
def flagged(spark, sf_dir, unit="seconds", source="events") -> DataFrame:
    return TR.flag(FX.cdr_raw(spark, sf_dir, source), OCC_MAPPING, OCC_DEDUP_KEYS, unit, keep=["SOURCE_LINE"])


def valid(spark, sf_dir, source="events") -> DataFrame:
    return TR.valid_rows(flagged(spark, sf_dir, source=source))


# "First" inside a file: the line, then the row's own values, so rows of a
# source whose ids repeat (lineitem) still have one deterministic first row.
FIRST_ORDER = ("SOURCE_LINE", "LOAD_TS", "CHARGE_AMOUNT", "A_MSISDN", "FLEX_FLD3", "EVENT_TYPE")


def merged(spark, sf_dir, policy="keep_first", source="events", columns=None):
    """Rows to insert and failing files.  The valid rows are flagged once and written, as in a load run.

    ``columns`` of the rows beside their key and place (default: all).
    """
    rows = valid(spark, sf_dir, source)
    if columns is not None:
        rows = rows.select("DEDUP_KEY", *dict.fromkeys(["SOURCE_DIR", "SOURCE_FILE", *FIRST_ORDER, *columns]))
    return MG.merge_insert_absent(
        TB.shared_copy(rows, "valid"), FX.detail_existing(spark, sf_dir, source), "DEDUP_KEY", "CHARGING_ID", policy, FIRST_ORDER
    )


def detail(spark, sf_dir, source="events") -> DataFrame:
    """The detail rows this batch inserts (keep_first), typed, as a written table."""
    ins, _ = merged(spark, sf_dir, "keep_first", source)
    return TB.shared_copy(ins.select(*TR.detail_projection(), "SOURCE_FILE", "SOURCE_DIR"), "detail")


DETAIL_OUT = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in O.DECIMAL_COLS else c for c in O.DETAIL_COLS
)

# --------------------------------------------------------------------------
# T: projections, filters, scalar functions
# --------------------------------------------------------------------------
register(
    "transform_occ",
    O.with_base(f"SELECT {O.detail_select(as_double=True)}, SOURCE_FILE, SOURCE_LINE FROM valid"),
)(lambda spark, d: _as_double(valid(spark, d).select(*TR.detail_projection(), "SOURCE_FILE", "SOURCE_LINE")))


register(
    "clean_msisdn",
    O.with_base("SELECT SOURCE_LINE, A_MSISDN, B_MSISDN FROM flagged"),
)(lambda spark, d: flagged(spark, d).select("SOURCE_LINE", "A_MSISDN", "B_MSISDN"))


_WIDE = "concat_ws('|', APN, CALL_TYPE, EVENT_TYPE, CHARGING_ID, SERVICE_ID, SUBSCRIBER_TYPE, PARTNER, FLEX_FLD3, A_MSISDN, B_MSISDN)"
_CUTS = (("WIDE_20", 20), ("WIDE_50", 50), ("WIDE_100", 100))


@register(
    "truncate_strings",
    "WITH cdr_raw AS (" + O.CDR_RAW + ") SELECT SOURCE_LINE, "
    + ", ".join(f"NULLIF(substr(trim({_WIDE}), 1, {n}), '') AS {name}" for name, n in _CUTS)
    + f", CAST(length({_WIDE}) AS BIGINT) AS WIDE_LEN FROM cdr_raw",
)
def q_truncate_strings(spark, sf_dir):
    from cdrflow.functions.cleaning import clean_string

    raw = FX.cdr_raw(spark, sf_dir).withColumn("WIDE", F.expr(_WIDE))
    cols = [clean_string(F.col("WIDE"), ColumnSpec("WIDE", name, True, "string", "trim", n)).alias(name) for name, n in _CUTS]
    return raw.select("SOURCE_LINE", *cols, F.length("WIDE").cast("bigint").alias("WIDE_LEN"))


_NUMS = [s for s in OCC_MAPPING if s.kind == "number"]


@register(
    "safe_number",
    O.with_base("SELECT SOURCE_LINE, " + ", ".join(f"CAST({s.target} AS DOUBLE) AS {s.target}" for s in _NUMS) + " FROM flagged"),
)
def q_safe_number(spark, sf_dir):
    return _as_double(flagged(spark, sf_dir).select("SOURCE_LINE", *[s.target for s in _NUMS]))


register(
    "epoch_seconds",
    O.with_base("SELECT SOURCE_LINE, ORIG_START_TIME, START_DATE, START_HOUR FROM flagged"),
)(lambda spark, d: flagged(spark, d).select("SOURCE_LINE", "ORIG_START_TIME", "START_DATE", "START_HOUR"))


# Millisecond epochs: the seconds text followed by three digits from the id.
_MS_SPARK = "concat(ORIG_START_TIME, lpad(cast(SOURCE_LINE % 1000 as string), 3, '0'))"
_MS_DUCK = "ORIG_START_TIME || lpad(CAST(SOURCE_LINE % 1000 AS VARCHAR), 3, '0')"


@register(
    "epoch_millis",
    "WITH cdr_raw AS (" + O.CDR_RAW + f"), ms AS (SELECT SOURCE_LINE, {_MS_DUCK} AS MS FROM cdr_raw) "
    f"SELECT SOURCE_LINE, MS, {O.epoch_ts_sql('MS', 'milliseconds')} AS START_DATE, "
    f"CAST(hour({O.epoch_ts_sql('MS', 'milliseconds')}) AS INTEGER) AS START_HOUR FROM ms",
)
def q_epoch_millis(spark, sf_dir):
    from cdrflow.functions.cleaning import epoch_to_ntz, start_hour

    ms = FX.cdr_raw(spark, sf_dir).select("SOURCE_LINE", F.expr(_MS_SPARK).alias("MS"))
    ts = epoch_to_ntz(F.col("MS"), "milliseconds")
    return ms.select("SOURCE_LINE", "MS", ts.alias("START_DATE"), start_hour(ts).alias("START_HOUR"))


register(
    "start_hour",
    O.with_base("SELECT START_HOUR, COUNT(*) AS EVENTS FROM valid GROUP BY START_HOUR"),
)(lambda spark, d: valid(spark, d).groupBy("START_HOUR").agg(F.count(F.lit(1)).alias("EVENTS")))


register(
    "default_fill",
    O.with_base("SELECT SOURCE_LINE, KEYWORD FROM flagged"),
)(lambda spark, d: flagged(spark, d).select("SOURCE_LINE", "KEYWORD"))


_OPT_STR = [s.target for s in OCC_MAPPING if s.kind == "string" and not s.required and s.target]


@register(
    "blank_to_null",
    O.with_base(
        "SELECT COUNT(*) AS ROWS_TOTAL, "
        + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS NULL_{c}" for c in _OPT_STR)
        + ", COUNT(*) FILTER (WHERE ORIG_START_TIME IS NULL) AS NULL_ORIG_START_TIME FROM flagged"
    ),
)
def q_blank_to_null(spark, sf_dir):
    f = flagged(spark, sf_dir)
    return f.agg(
        F.count(F.lit(1)).alias("ROWS_TOTAL"),
        *[F.count_if(F.col(c).isNull()).alias(f"NULL_{c}") for c in _OPT_STR],
        F.count_if(F.col("ORIG_START_TIME").isNull()).alias("NULL_ORIG_START_TIME"),
    )


register(
    "dedup_key",
    O.with_base("SELECT SOURCE_LINE, DEDUP_KEY FROM flagged"),
)(lambda spark, d: flagged(spark, d).select("SOURCE_LINE", "DEDUP_KEY"))


@register(
    "validity_filter",
    O.with_base(
        """SELECT SOURCE_FILE, COUNT(*) AS RAW_ROWS,
  COUNT(*) FILTER (WHERE len(list_filter(REJECT_REASONS, lambda r: starts_with(r, 'REQUIRED_BLANK'))) > 0) AS REQUIRED_BLANK,
  COUNT(*) FILTER (WHERE len(list_filter(REJECT_REASONS, lambda r: starts_with(r, 'BAD_TIMESTAMP'))) > 0) AS BAD_TIMESTAMP,
  COUNT(*) FILTER (WHERE len(REJECT_REASONS) > 0) AS REJECTED,
  COUNT(*) FILTER (WHERE len(REJECT_REASONS) = 0) AS VALID,
  COUNT(DISTINCT DEDUP_KEY) FILTER (WHERE len(REJECT_REASONS) = 0) AS DISTINCT_KEYS
FROM flagged GROUP BY SOURCE_FILE"""
    ),
)
def q_validity_filter(spark, sf_dir):
    f = flagged(spark, sf_dir)

    def has(prefix):
        return F.exists("REJECT_REASONS", lambda r: r.startswith(prefix))

    return f.groupBy("SOURCE_FILE").agg(
        F.count(F.lit(1)).alias("RAW_ROWS"),
        F.count_if(has(TR.REQUIRED_BLANK)).alias("REQUIRED_BLANK"),
        F.count_if(has(TR.BAD_TIMESTAMP)).alias("BAD_TIMESTAMP"),
        F.count_if(~TR.is_valid()).alias("REJECTED"),
        F.count_if(TR.is_valid()).alias("VALID"),
        F.count_distinct(F.when(TR.is_valid(), F.col("DEDUP_KEY"))).alias("DISTINCT_KEYS"),
    )


register(
    "reject_reasons",
    O.with_base(
        "SELECT SOURCE_DIR, SOURCE_FILE, REASON, COUNT(*) AS REJECTED_ROWS FROM "
        "(SELECT SOURCE_DIR, SOURCE_FILE, unnest(REJECT_REASONS) AS REASON FROM flagged WHERE len(REJECT_REASONS) > 0) "
        "GROUP BY SOURCE_DIR, SOURCE_FILE, REASON"
    ),
)(lambda spark, d: TR.reject_report(flagged(spark, d)))


register(
    "reject_rows",
    O.with_base(
        "SELECT SOURCE_DIR, SOURCE_FILE, SOURCE_LINE, array_to_string(REJECT_REASONS, '; ') AS REASONS "
        "FROM flagged WHERE len(REJECT_REASONS) > 0"
    ),
)(lambda spark, d: TR.reject_rows(flagged(spark, d)))

_NOT_NULL = [f.name for f in detail_schema().fields if not f.nullable]

register(
    "not_null_check",
    O.with_base(
        "SELECT SOURCE_DIR, SOURCE_FILE, COLUMN_NAME, NULLS FROM ("
        + " UNION ALL ".join(
            f"SELECT SOURCE_DIR, SOURCE_FILE, '{c}' AS COLUMN_NAME, COUNT(*) AS NULLS FROM flagged WHERE {c} IS NULL GROUP BY ALL"
            for c in _NOT_NULL
        )
        + ")"
    ),
)(lambda spark, d: TR.null_violations(flagged(spark, d)))


# Overflow variant of the staging rows: every 61st charge gets 15 extra digits.
_OVF_SPARK = "CASE WHEN SOURCE_LINE % 61 = 0 THEN concat(cast(SOURCE_LINE as string), '000000000000000') ELSE CHARGE_AMOUNT END"
_OVF_DUCK = "CASE WHEN SOURCE_LINE % 61 = 0 THEN CAST(SOURCE_LINE AS VARCHAR) || '000000000000000' ELSE CHARGE_AMOUNT END"


@register(
    "constraint_check",
    "WITH cdr_raw0 AS (" + O.CDR_RAW + f"), cdr_raw AS (SELECT * REPLACE ({_OVF_DUCK} AS CHARGE_AMOUNT) FROM cdr_raw0), "
    f"flagged AS ({O.flagged_sql('cdr_raw')}) "
    "SELECT SOURCE_DIR, SOURCE_FILE, COLUMN_NAME, COUNT(*) AS VIOLATIONS FROM "
    "(SELECT SOURCE_DIR, SOURCE_FILE, unnest(CONSTRAINT_VIOLATIONS) AS COLUMN_NAME FROM flagged "
    "WHERE len(CONSTRAINT_VIOLATIONS) > 0) GROUP BY SOURCE_DIR, SOURCE_FILE, COLUMN_NAME",
)
def q_constraint_check(spark, sf_dir):
    raw = FX.cdr_raw(spark, sf_dir).withColumn("CHARGE_AMOUNT", F.expr(_OVF_SPARK))
    return TR.check_constraints(TR.flag(raw, keep=["SOURCE_LINE"]))


# --------------------------------------------------------------------------
# J: merge / de-duplication
# --------------------------------------------------------------------------
_STATS_SQL = """
SELECT v.SOURCE_DIR, v.SOURCE_FILE, v.TMP_ROWS, v.VALID_ROWS,
       CAST(COALESCE(i.INSERTED, 0) AS BIGINT) AS INSERTED,
       CAST(v.VALID_ROWS - COALESCE(i.INSERTED, 0) AS BIGINT) AS DUPLICATES,
       v.REJECTED_ROWS, FALSE AS FAILED
FROM (SELECT SOURCE_DIR, SOURCE_FILE, COUNT(*) AS TMP_ROWS,
             COUNT(*) FILTER (WHERE len(REJECT_REASONS) = 0) AS VALID_ROWS,
             COUNT(*) FILTER (WHERE len(REJECT_REASONS) > 0) AS REJECTED_ROWS
      FROM flagged GROUP BY SOURCE_DIR, SOURCE_FILE) v
LEFT JOIN (SELECT SOURCE_DIR, SOURCE_FILE, COUNT(*) AS INSERTED FROM inserted GROUP BY SOURCE_DIR, SOURCE_FILE) i
  USING (SOURCE_DIR, SOURCE_FILE)
"""


@register("transform_stats", O.with_base(_STATS_SQL))
def q_transform_stats(spark, sf_dir):
    f = flagged(spark, sf_dir)
    ins, failed = merged(spark, sf_dir, "keep_first", columns=[])
    return TR.transform_stats(f, ins, failed)


register(
    "merge_insert_absent",
    O.with_base(f"SELECT {DETAIL_OUT}, SOURCE_FILE, SOURCE_DIR FROM detail"),
)(lambda spark, d: _as_double(detail(spark, d)))


register(
    "dup_keep_first",
    O.with_base("SELECT DEDUP_KEY AS CHARGING_ID, SOURCE_FILE, SOURCE_LINE FROM inserted"),
)(lambda spark, d: merged(spark, d, "keep_first")[0].select(F.col("DEDUP_KEY").alias("CHARGING_ID"), "SOURCE_FILE", "SOURCE_LINE"))

_FAIL_FILE_SQL = """
, new_rows AS (
  SELECT v.* FROM valid v
  WHERE NOT EXISTS (SELECT 1 FROM detail_existing d WHERE d.CHARGING_ID = v.DEDUP_KEY)),
failed AS (
  SELECT DISTINCT SOURCE_DIR, SOURCE_FILE FROM new_rows
  GROUP BY SOURCE_DIR, SOURCE_FILE, DEDUP_KEY HAVING COUNT(*) > 1),
kept AS (
  SELECT * FROM new_rows n
  WHERE NOT EXISTS (SELECT 1 FROM failed f WHERE f.SOURCE_DIR = n.SOURCE_DIR AND f.SOURCE_FILE = n.SOURCE_FILE)),
ff_inserted AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY DEDUP_KEY ORDER BY SOURCE_FILE, SOURCE_DIR, SOURCE_LINE) AS rn2
                 FROM kept) WHERE rn2 = 1)
"""

register(
    "dup_fail_file",
    "WITH " + O.base_ctes() + _FAIL_FILE_SQL
    + "SELECT DEDUP_KEY AS CHARGING_ID, SOURCE_FILE, SOURCE_LINE FROM ff_inserted",
)(lambda spark, d: merged(spark, d, "fail_file")[0].select(F.col("DEDUP_KEY").alias("CHARGING_ID"), "SOURCE_FILE", "SOURCE_LINE"))

register(
    "dup_failed_files",
    "WITH " + O.base_ctes() + _FAIL_FILE_SQL + "SELECT SOURCE_DIR, SOURCE_FILE FROM failed",
)(lambda spark, d: merged(spark, d, "fail_file", columns=[])[1])


# --------------------------------------------------------------------------
# Audit
# --------------------------------------------------------------------------
def audit(spark, sf_dir) -> DataFrame:
    return FX.load_audit(spark, sf_dir)


def audit_events(spark, sf_dir) -> DataFrame:
    """Event log: DOWNLOADED at start, then the final state (if any)."""
    cur = audit(spark, sf_dir)
    start = A.audit_event(cur, "DOWNLOADED", F.timestamp_add("MINUTE", F.lit(-5), F.col("LOAD_TS")), seq=0)
    end = A.audit_event(
        cur.where(F.col("STATUS") != "DOWNLOADED"),
        F.col("STATUS"),
        F.col("LOAD_TS"),
        F.col("MESSAGE"),
        F.col("ROWS_CSV"),
        F.col("ROWS_DB"),
        seq=1,
    )
    # files still DOWNLOADED keep their start time
    start_only = A.audit_event(cur.where(F.col("STATUS") == "DOWNLOADED"), "DOWNLOADED", F.col("LOAD_TS"), seq=2)
    return start.unionByName(end).unionByName(start_only)


register("audit_latest", "WITH load_audit AS (" + O.LOAD_AUDIT + ") SELECT * FROM load_audit")(
    lambda spark, d: A.audit_latest(audit_events(spark, d))
)

register(
    "error_classes",
    "WITH load_audit AS (" + O.LOAD_AUDIT + ") SELECT split_part(MESSAGE, ':', 1) AS ERROR_CLASS, "
    "COUNT(*) AS FILE_COUNT FROM load_audit WHERE STATUS = 'ERROR' GROUP BY 1",
)(lambda spark, d: A.error_classes(audit(spark, d)))


_AUDIT_MSG_SQL = (
    "WITH load_audit AS (" + O.LOAD_AUDIT + ") SELECT SOURCE_DIR, FILE_NAME, FILE_SIZE, "
    "TRY_CAST(NULLIF(regexp_extract(MESSAGE, 'TMP:([0-9]+)', 1), '') AS BIGINT) AS TMP_ROWS, "
    "TRY_CAST(NULLIF(regexp_extract(MESSAGE, 'DETAIL:([0-9]+)', 1), '') AS BIGINT) AS DETAIL_ROWS, "
    "TRY_CAST(NULLIF(regexp_extract(MESSAGE, 'REJECTED:([0-9]+)', 1), '') AS BIGINT) AS REJECTED_ROWS, "
    "MESSAGE AS REBUILT_MESSAGE FROM load_audit WHERE STATUS = 'SUCCESS'"
)


@register("audit_message", _AUDIT_MSG_SQL)
def q_audit_message(spark, sf_dir):
    parsed = A.parse_success_message(audit(spark, sf_dir))
    return parsed.withColumn("REBUILT_MESSAGE", A.success_message("TMP_ROWS", "DETAIL_ROWS", "REJECTED_ROWS"))


# Step failures per file, derived from the order key (first failing step wins).
_STEPS = (
    ("DOWNLOAD_ERROR", 11, "size mismatch"),
    ("CSV_INVALID", 7, "Empty file"),
    ("WHITELIST_ERROR", 5, "Unknown columns: X"),
    ("LOAD_ERROR", 3, "Wrong column count"),
    ("TRANSFORM_ERROR", 2, "duplicate key"),
)


@register(
    "file_outcome",
    "WITH load_audit AS (" + O.LOAD_AUDIT + "), s AS (SELECT SOURCE_DIR, FILE_NAME, FILE_SIZE, "
    "CAST(regexp_extract(FILE_NAME, '_([0-9]+)\\.csv', 1) AS BIGINT) AS k FROM load_audit) "
    "SELECT SOURCE_DIR, FILE_NAME, FILE_SIZE, CASE WHEN "
    + " AND ".join(f"k % {m} <> 0" for _, m, _ in _STEPS)
    + " THEN 'SUCCESS' ELSE 'ERROR' END AS STATUS, CASE "
    + " ".join(f"WHEN k % {m} = 0 THEN '{c}'" for c, m, _ in _STEPS)
    + " END AS ERROR_CLASS, CASE "
    + " ".join(f"WHEN k % {m} = 0 THEN '{c}: {t}'" for c, m, t in _STEPS)
    + " END AS MESSAGE FROM s",
)
def q_file_outcome(spark, sf_dir):
    cur = audit(spark, sf_dir).select("SOURCE_DIR", "FILE_NAME", "FILE_SIZE")
    k = F.regexp_extract("FILE_NAME", r"_([0-9]+)\.csv", 1).cast("bigint")
    steps = cur.select("SOURCE_DIR", "FILE_NAME", "FILE_SIZE",
                       *[F.when(k % m == 0, F.lit(t)).alias(c) for c, m, t in _STEPS])
    return A.file_outcome(steps)


# --------------------------------------------------------------------------
# Monitoring pack
# --------------------------------------------------------------------------
_AUD = "WITH load_audit AS (" + O.LOAD_AUDIT + ") "
_FMT = "strftime(LOAD_TS, '%Y-%m-%d %H:%M:%S')"


def _pct2_sql(num: str, den: str) -> str:
    n, d = f"CAST({num} AS BIGINT)", f"NULLIF(CAST({den} AS BIGINT), 0)"
    return f"CAST(sign({n}) * ((20000 * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / 100.0"


def _avg2_sql(col: str, scale_units: int = 100000) -> str:
    """round(avg(decimal col), 2) half away from zero, in exact integers."""
    u = f"CAST(SUM({col}) * {scale_units} AS HUGEINT)"
    n = f"COUNT({col})"
    half = scale_units // 100
    return (
        f"CAST(sign({u}) * ((2 * abs({u}) + {half} * {n}) // (2 * {half} * {n})) AS DOUBLE) / 100.0"
    )


register(
    "m_recent_loads",
    _AUD + f"SELECT SOURCE_DIR, FILE_NAME, STATUS, ROWS_CSV, substr(MESSAGE, 1, 100) AS MESSAGE_SHORT, "
    f"{_FMT} AS LOAD_TIME FROM load_audit WHERE LOAD_TS >= {O.AS_OF} - INTERVAL 1 DAY",
)(lambda spark, d: M.m_recent_loads(audit(spark, d), AS_OF))

register(
    "m_status_today",
    _AUD + f"SELECT STATUS, COUNT(*) AS FILE_COUNT, CAST(SUM(ROWS_CSV) AS BIGINT) AS TOTAL_ROWS FROM load_audit "
    f"WHERE LOAD_TS >= {O.TODAY} AND LOAD_TS < {O.TOMORROW} GROUP BY STATUS",
)(lambda spark, d: M.m_status_today(audit(spark, d), TODAY))

register(
    "m_success_rate",
    _AUD + "SELECT SOURCE_DIR, COUNT(*) AS TOTAL_FILES, "
    "CAST(SUM(CASE WHEN STATUS = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS SUCCESS_COUNT, "
    + _pct2_sql("SUM(CASE WHEN STATUS = 'SUCCESS' THEN 1 ELSE 0 END)", "COUNT(*)")
    + f" AS SUCCESS_RATE_PCT FROM load_audit WHERE LOAD_TS >= {O.AS_OF} - INTERVAL 7 DAY GROUP BY SOURCE_DIR",
)(lambda spark, d: M.m_success_rate(audit(spark, d), AS_OF))

register(
    "m_last_errors",
    _AUD + f"SELECT FILE_NAME, SOURCE_DIR, {_FMT} AS ERROR_TIME, MESSAGE FROM load_audit WHERE STATUS = 'ERROR' "
    "ORDER BY LOAD_TS DESC NULLS FIRST, FILE_NAME, SOURCE_DIR, FILE_SIZE LIMIT 20",
)(lambda spark, d: M.m_last_errors(audit(spark, d)))

_RR = (
    "TRY_CAST(NULLIF(regexp_extract(MESSAGE, '{t}:([0-9]+)', 1), '') AS BIGINT)"
)
register(
    "m_reject_rate",
    _AUD + "SELECT FILE_NAME, LOAD_TIME, TMP_ROWS, DETAIL_ROWS, REJECTED_ROWS, REJECT_RATE_PCT FROM ("
    f"SELECT FILE_NAME, SOURCE_DIR, FILE_SIZE, {_FMT} AS LOAD_TIME, "
    + _RR.format(t="TMP") + " AS TMP_ROWS, "
    + _RR.format(t="DETAIL") + " AS DETAIL_ROWS, "
    + _RR.format(t="REJECTED") + " AS REJECTED_ROWS, "
    + _pct2_sql(_RR.format(t="REJECTED"), _RR.format(t="TMP"))
    + f" AS REJECT_RATE_PCT FROM load_audit WHERE STATUS = 'SUCCESS' AND LOAD_TS >= {O.AS_OF} - INTERVAL 7 DAY) "
    "ORDER BY REJECT_RATE_PCT DESC NULLS LAST, FILE_NAME, SOURCE_DIR, FILE_SIZE LIMIT 20",
)(lambda spark, d: M.m_reject_rate(audit(spark, d), AS_OF))


def staging_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {"RA_T_TMP_OCC": FX.cdr_raw(spark, sf_dir), "RA_T_TMP_MMG": FX.staging_mmg(spark, sf_dir)}


_STG = "WITH cdr_raw AS (" + O.CDR_RAW + "), staging_mmg AS (" + O.STAGING_MMG + ") "

register(
    "m_staging_counts",
    _STG + "SELECT 'RA_T_TMP_OCC' AS TABLE_NAME, COUNT(*) AS ROW_COUNT, COUNT(DISTINCT SOURCE_FILE) AS FILE_COUNT "
    "FROM cdr_raw UNION ALL SELECT 'RA_T_TMP_MMG', COUNT(*), COUNT(DISTINCT SOURCE_FILE) FROM staging_mmg",
)(lambda spark, d: M.m_staging_counts(staging_tables(spark, d)))

register(
    "m_staging_files",
    _STG + "SELECT 'OCC' AS SOURCE_TYPE, SOURCE_FILE, COUNT(*) AS ROW_COUNT, MIN(LOAD_TS) AS FIRST_LOAD, "
    "MAX(LOAD_TS) AS LAST_LOAD FROM cdr_raw GROUP BY SOURCE_FILE UNION ALL "
    "SELECT 'MMG', SOURCE_FILE, COUNT(*), MIN(LOAD_TS), MAX(LOAD_TS) FROM staging_mmg GROUP BY SOURCE_FILE",
)(lambda spark, d: M.m_staging_files({"OCC": FX.cdr_raw(spark, d), "MMG": FX.staging_mmg(spark, d)}))

_DET_SINCE = "START_DATE >= TIMESTAMP '{d} 00:00:00'"

register(
    "m_daily_volume",
    O.with_base(
        "SELECT CAST(START_DATE AS DATE) AS DATE_JOUR, COUNT(*) AS TOTAL_EVENTS, "
        "CAST(SUM(DATA_VOLUME) AS DOUBLE) AS TOTAL_DATA_MB, " + _avg2_sql("CHARGE_AMOUNT")
        + " AS AVG_CHARGE FROM detail WHERE " + _DET_SINCE.format(d="2024-01-01") + " GROUP BY 1"
    ),
)(lambda spark, d: M.m_daily_volume(detail(spark, d), AS_OF))

register(
    "m_top_msisdn",
    O.with_base(
        "SELECT A_MSISDN, COUNT(*) AS EVENT_COUNT, CAST(round(SUM(DATA_VOLUME), 2) AS DOUBLE) AS TOTAL_DATA_MB, "
        "CAST(round(SUM(CHARGE_AMOUNT), 2) AS DOUBLE) AS TOTAL_CHARGE FROM detail WHERE "
        + _DET_SINCE.format(d="2024-01-24")
        + " GROUP BY A_MSISDN ORDER BY TOTAL_DATA_MB DESC NULLS FIRST, A_MSISDN ASC NULLS LAST LIMIT 10"
    ),
)(lambda spark, d: M.m_top_msisdn(detail(spark, d), AS_OF))

_TODAY_RANGE = "START_DATE >= TIMESTAMP '2024-01-30 00:00:00' AND START_DATE < TIMESTAMP '2024-01-31 00:00:00'"

register(
    "m_event_mix",
    O.with_base(
        "SELECT EVENT_TYPE, CALL_TYPE, COUNT(*) AS EVENT_COUNT, CAST(round(SUM(DATA_VOLUME), 2) AS DOUBLE) AS TOTAL_DATA_MB "
        f"FROM detail WHERE {_TODAY_RANGE} GROUP BY EVENT_TYPE, CALL_TYPE"
    ),
)(lambda spark, d: M.m_event_mix(detail(spark, d), TODAY))

register(
    "m_hourly",
    O.with_base(
        "SELECT START_HOUR, COUNT(*) AS EVENT_COUNT, " + _avg2_sql("DATA_VOLUME")
        + f" AS AVG_DATA_MB FROM detail WHERE {_TODAY_RANGE} GROUP BY START_HOUR"
    ),
)(lambda spark, d: M.m_hourly(detail(spark, d), TODAY))

_NULL_COLS = ("B_MSISDN", "EVENT_COUNT", "DATA_VOLUME")
register(
    "m_null_profile",
    O.with_base(
        "SELECT COLUMN_NAME, NULL_COUNT, " + _pct2_sql("NULL_COUNT", "N") + " AS NULL_PCT FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS COLUMN_NAME, COUNT(*) FILTER (WHERE {c} IS NULL) AS NULL_COUNT, COUNT(*) AS N "
            f"FROM detail WHERE " + _DET_SINCE.format(d="2024-01-30")
            for c in _NULL_COLS
        )
        + ")"
    ),
)(lambda spark, d: M.m_null_profile(detail(spark, d), AS_OF))

# Run on the valid rows before de-duplication, where repeated keys exist.
register(
    "m_dup_keys",
    O.with_base("SELECT DEDUP_KEY AS CHARGING_ID, COUNT(*) AS DUPLICATE_COUNT FROM valid GROUP BY DEDUP_KEY HAVING COUNT(*) > 1"),
)(lambda spark, d: M.m_dup_keys(valid(spark, d).select(F.col("DEDUP_KEY").alias("CHARGING_ID"))))

register(
    "m_dup_keys_detail",
    O.with_base("SELECT CHARGING_ID, COUNT(*) AS DUPLICATE_COUNT FROM detail GROUP BY CHARGING_ID HAVING COUNT(*) > 1"),
)(lambda spark, d: M.m_dup_keys(detail(spark, d)))

register(
    "m_bad_msisdn",
    O.with_base(
        "SELECT A_MSISDN, COUNT(*) AS EVENT_COUNT FROM detail WHERE " + _DET_SINCE.format(d="2024-01-30")
        + " AND (length(A_MSISDN) < 8 OR NOT regexp_matches(A_MSISDN, '\\A[0-9+]+\\z')) GROUP BY A_MSISDN"
    ),
)(lambda spark, d: M.m_bad_msisdn(detail(spark, d), AS_OF))

register(
    "v_recent",
    O.with_base(f"SELECT {DETAIL_OUT}, SOURCE_FILE, SOURCE_DIR FROM detail WHERE " + _DET_SINCE.format(d="2024-01-01")),
)(lambda spark, d: _as_double(M.v_recent(detail(spark, d), AS_OF)))

register(
    "v_recent_newest",
    O.with_base(
        f"SELECT {DETAIL_OUT}, SOURCE_FILE, SOURCE_DIR FROM detail WHERE " + _DET_SINCE.format(d="2024-01-01")
        + " ORDER BY START_DATE DESC, CHARGING_ID LIMIT 100"
    ),
)(lambda spark, d: _as_double(M.newest_first(M.v_recent(detail(spark, d), AS_OF), 100)))

_TEXT_COLS = [s.source for s in OCC_MAPPING] + ["SOURCE_DIR"]
register(
    "table_profile",
    _STG + "SELECT 'RA_T_TMP_OCC' AS TABLE_NAME, COUNT(*) AS ROW_COUNT, COUNT(DISTINCT SOURCE_FILE) AS FILE_COUNT, "
    "CAST((200 * SUM(" + " + ".join(f"COALESCE(octet_length(encode({c})), 0)" for c in _TEXT_COLS)
    + ") + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100.0 AS AVG_ROW_LEN FROM cdr_raw",
)(lambda spark, d: M.table_profile(FX.cdr_raw(spark, d).select(*_TEXT_COLS, "SOURCE_FILE"), "RA_T_TMP_OCC"))

_DASHBOARD_SQL = (
    "WITH " + O.base_ctes() + ", load_audit AS (" + O.LOAD_AUDIT + "), staging_mmg AS (" + O.STAGING_MMG + "), "
    "a AS (SELECT COUNT(*) AS FILES_24H, COUNT(*) FILTER (WHERE STATUS = 'SUCCESS') AS FILES_SUCCESS_24H, "
    "COUNT(*) FILTER (WHERE STATUS = 'ERROR') AS FILES_ERROR_24H, "
    "CAST(SUM(ROWS_CSV) FILTER (WHERE STATUS = 'SUCCESS') AS BIGINT) AS ROWS_PROCESSED_24H "
    f"FROM load_audit WHERE LOAD_TS >= {O.AS_OF} - INTERVAL 1 DAY), "
    f"d AS (SELECT COUNT(*) FILTER (WHERE START_DATE >= {O.AS_OF}) AS DETAIL_OCC_TODAY, COUNT(*) AS DETAIL_OCC_TOTAL FROM detail), "
    "o AS (SELECT COUNT(*) AS TMP_OCC_ROWS FROM cdr_raw), m AS (SELECT COUNT(*) AS TMP_MMG_ROWS FROM staging_mmg) "
    "SELECT a.*, o.*, m.*, d.* FROM a CROSS JOIN o CROSS JOIN m CROSS JOIN d"
)

register("v_dashboard", _DASHBOARD_SQL)(
    lambda spark, d: M.v_dashboard(audit(spark, d), FX.cdr_raw(spark, d), FX.staging_mmg(spark, d), detail(spark, d), AS_OF)
)


def with_views(spark, sf_dir) -> None:
    register_views(spark, audit(spark, sf_dir), FX.cdr_raw(spark, sf_dir), FX.staging_mmg(spark, sf_dir), detail(spark, sf_dir))


@register("v_dashboard_by_name", _DASHBOARD_SQL)
def q_dashboard_by_name(spark, sf_dir):
    with_views(spark, sf_dir)
    return spark.sql(f"SELECT * FROM cdr_dashboard(TIMESTAMP_NTZ'{AS_OF}')")


@register(
    "v_recent_by_name",
    O.with_base(f"SELECT {DETAIL_OUT}, SOURCE_FILE, SOURCE_DIR FROM detail WHERE " + _DET_SINCE.format(d="2024-01-24")),
)
def q_recent_by_name(spark, sf_dir):
    with_views(spark, sf_dir)
    return _as_double(spark.sql(f"SELECT * FROM cdr_recent(TIMESTAMP_NTZ'{AS_OF}', 7)"))


_SKETCHED = ["A_MSISDN", "EVENT_TYPE", "CHARGING_ID", "DATA_VOLUME", "CHARGE_AMOUNT", "EVENT_DURATION", "B_MSISDN"]
_SKETCH_WINDOWS = (("2024-01-24", "2024-01-31"), ("2024-01-01", "2024-01-31"))
_OF_NUMBER = "{c} IN ('DATA_VOLUME', 'CHARGE_AMOUNT', 'EVENT_DURATION')"


@register(
    "m_window_statistics",
    O.with_base(" UNION ALL ".join(
        f"SELECT CAST('{lo}' AS DATE) AS FIRST_DAY, '{c}' AS COLUMN_NAME, COUNT(*) AS ROW_COUNT, COUNT(*) - COUNT({c}) AS NULL_COUNT, "
        f"COUNT(DISTINCT {c}) AS DISTINCT_EXACT, TRUE AS DISTINCT_OK, "
        + ", ".join(f"CASE WHEN {_OF_NUMBER.format(c=chr(39) + c + chr(39))} THEN TRUE END AS {q}_OK" for q in ("MEDIAN", "P95"))
        + f" FROM detail WHERE CAST(START_DATE AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'"
        for lo, hi in _SKETCH_WINDOWS for c in _SKETCHED
    )),
)
def q_window_statistics(spark, sf_dir):
    """Two windows from one set of daily sketches, with the exact counts beside the estimates' bounds."""
    rows = detail(spark, sf_dir)
    sketches = TB.shared_copy(SK.daily_sketches(rows, _SKETCHED), "daily-sketches")
    parts = [
        SK.checked_statistics(rows, SK.window_statistics(sketches, lo, hi), _SKETCHED, lo, hi)
        .select(F.lit(lo).cast("date").alias("FIRST_DAY"), "*")
        for lo, hi in _SKETCH_WINDOWS
    ]
    return parts[0].unionByName(parts[1])


def flagship(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """Staging -> flags -> typed detail -> keep_first -> insert-if-absent,
    summarised per event type."""
    configure(spark)
    inserted, _ = merged(spark, sf_dir, "keep_first", source, columns=["EVENT_TYPE", "DATA_VOLUME", "A_MSISDN"])
    return inserted.groupBy("EVENT_TYPE").agg(
        F.count(F.lit(1)).alias("INSERTED"),
        F.sum("DATA_VOLUME").cast(T.DoubleType()).alias("TOTAL_DATA_MB"),
        F.count_distinct("A_MSISDN").alias("SUBSCRIBERS"),
    )


register(
    "flagship_event_type",
    O.with_base(
        "SELECT EVENT_TYPE, COUNT(*) AS INSERTED, CAST(SUM(DATA_VOLUME) AS DOUBLE) AS TOTAL_DATA_MB, "
        "COUNT(DISTINCT A_MSISDN) AS SUBSCRIBERS FROM detail GROUP BY EVENT_TYPE"
    ),
)(flagship)

_FLAGSHIP_SQL = (
    "SELECT EVENT_TYPE, COUNT(*) AS INSERTED, CAST(SUM(DATA_VOLUME) AS DOUBLE) AS TOTAL_DATA_MB, "
    "COUNT(DISTINCT A_MSISDN) AS SUBSCRIBERS FROM detail GROUP BY EVENT_TYPE"
)

# Same recipe over lineitem: six times the rows of events.
register("flagship_lineitem", O.with_base(_FLAGSHIP_SQL, source="lineitem"))(
    lambda spark, d: flagship(spark, d, "lineitem")
)

from cdrflow.plans import registry_ingest as _ingest  # noqa: E402,F401  (registers ingest queries)
from cdrflow.plans import registry_maintain as _maintain  # noqa: E402,F401  (registers maintenance queries)
