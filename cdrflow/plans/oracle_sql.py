"""DuckDB SQL oracles for the registered queries.

Each oracle recomputes the expected result straight from the driver's parquet
views (``events``, ``orders``, ``documents``) with plain SQL, independently of
the Spark code path.  The fixture rules below are the SQL twin of
``plans.fixtures``; the transform SQL is generated from the same mapping data
but with its own expression logic.
"""

from __future__ import annotations

from cdrflow.mapping import OCC_DEDUP_KEYS, OCC_MAPPING

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
TODAY = "TIMESTAMP '2024-01-30 00:00:00'"
TOMORROW = "TIMESTAMP '2024-01-31 00:00:00'"

EP = "CAST(epoch_us(ts) // 1000000 AS VARCHAR)"


def _s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _pad(x: str, n: int) -> str:
    return f"lpad({_s(x)}, {n}, '0')"


SOURCES = {
    "events": "events",
    "lineitem": (
        "(SELECT l_orderkey * 8 + l_linenumber AS event_id, l_shipdate AS ts, l_suppkey AS user_id, "
        "l_returnflag || l_linestatus AS event_type, l_extendedprice AS value, "
        "'{\"q\": ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '}' AS props FROM lineitem)"
    ),
}

CDR_RAW_TEMPLATE = f"""
SELECT
  'CDR_OCC_' || {_pad('event_id % 20', 2)} || '.csv' AS SOURCE_FILE,
  'OCC' AS SOURCE_DIR,
  ts AS LOAD_TS,
  event_id AS SOURCE_LINE,
  ' OCC ' AS DATASOURCE,
  CASE WHEN event_id % 31 = 0 THEN '12'
       WHEN event_id % 37 = 0 THEN chr(9) || '+216 ' || {_pad('user_id', 8)}
       ELSE '216' || {_pad('user_id', 8)} END AS A_MSISDN,
  CASE WHEN event_id % 5 = 0 THEN ''
       ELSE '216 ' || {_pad('(user_id * 7) % 100000', 8)} END AS B_MSISDN,
  CASE WHEN event_id % 97 = 0 THEN 'N/A'
       WHEN event_id % 101 = 0 THEN ' ' || {EP}
       ELSE {EP} END AS ORIG_START_TIME,
  CASE event_id % 3 WHEN 0 THEN 'internet' WHEN 1 THEN 'mms' ELSE ' wap ' END AS APN,
  CASE WHEN event_id % 2 = 0 THEN ' data ' ELSE 'sms' END AS CALL_TYPE,
  event_type AS EVENT_TYPE,
  CASE WHEN event_id % 89 = 0 THEN '   '
       WHEN event_id % 100 = 51 THEN ' CH' || {_s('event_id - 21')} || ' '
       WHEN event_id % 10 = 1 THEN ' CH' || {_s('event_id - 1')} || ' '
       ELSE 'CH' || {_s('event_id')} END AS CHARGING_ID,
  'SVC' || {_s('event_id % 13')} AS SERVICE_ID,
  CASE WHEN event_id % 2 = 0 THEN 'PREPAID' ELSE 'POSTPAID' END AS SUBSCRIBER_TYPE,
  CASE WHEN event_id % 3 = 0 THEN 'ROAM' ELSE 'HOME' END AS ROAMING_TYPE,
  'P' || {_s('event_id % 9')} AS PARTNER,
  CASE WHEN event_id % 113 = 0 THEN NULL ELSE 'F' || {_s('event_id % 4')} END AS FILTER_CODE,
  'x' AS FLEX_FLD1,
  'y' AS FLEX_FLD2,
  props AS FLEX_FLD3,
  CASE WHEN event_id % 43 = 0 THEN '1.5' ELSE {_s('1 + event_id % 3')} END AS EVENT_COUNT,
  CASE WHEN event_id % 41 = 0 THEN '1e3' WHEN event_id % 47 = 0 THEN ' 5'
       ELSE {_s('CAST(value AS DECIMAL(30,5))')} END AS DATA_VOLUME,
  {_s('(event_id * 17) % 3600')} AS EVENT_DURATION,
  CASE WHEN event_id % 53 = 0 THEN '-' ELSE '' END || {_s('CAST(value AS DECIMAL(20,5))')} AS CHARGE_AMOUNT,
  CASE WHEN event_id % 2 = 1 THEN '' ELSE '0.25' END AS DA_AMOUNT_CALC,
  CASE WHEN event_id % 59 = 0 THEN '.5' ELSE '+1.00000' END AS MA_AMNT_CALC,
  CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN NULL
       ELSE ' kw' || {_s('event_id % 6')} END AS KEYWORD,
  'CR' || {_s('event_id')} AS CALL_REFERENCE,
  'R' || {_s('event_id')} AS RECORD_ID
FROM __SOURCE__
"""


def cdr_raw_sql(source: str = "events") -> str:
    return CDR_RAW_TEMPLATE.replace("__SOURCE__", SOURCES[source])


def detail_existing_sql(source: str = "events") -> str:
    return f"SELECT 'CH' || {_s('event_id')} AS CHARGING_ID FROM {SOURCES[source]} WHERE event_id % 7 = 0"


CDR_RAW = cdr_raw_sql("events")
DETAIL_EXISTING = detail_existing_sql("events")

LOAD_AUDIT = f"""
SELECT
  CASE WHEN o_orderkey % 3 = 0 THEN 'MMG' ELSE 'OCC' END AS SOURCE_DIR,
  'CDR_' || CASE WHEN o_orderkey % 3 = 0 THEN 'MMG' ELSE 'OCC' END || '_' || {_s('o_orderkey')} || '.csv' AS FILE_NAME,
  CAST(1000 + o_custkey AS BIGINT) AS FILE_SIZE,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'ERROR' ELSE 'DOWNLOADED' END AS STATUS,
  {AS_OF} - to_minutes(CAST((o_orderkey * 29) % 43200 AS BIGINT)) AS LOAD_TS,
  CASE WHEN o_orderstatus = 'F' THEN
         'TMP:' || {_s('n')} || ' DETAIL:' || {_s('n - r')} || ' REJECTED:' || {_s('r')}
       WHEN o_orderstatus = 'P' THEN
         CASE o_orderkey % 4 WHEN 0 THEN 'CSV_INVALID: Empty file'
                             WHEN 1 THEN 'WHITELIST_ERROR: Unknown columns: X'
                             WHEN 2 THEN 'LOAD_ERROR: Wrong column count at data line 7 got=3 expected=25'
                             ELSE 'TRANSFORM_ERROR: duplicate key' END
       END AS MESSAGE,
  CASE WHEN o_orderstatus = 'F' THEN CAST(n AS BIGINT) END AS ROWS_CSV,
  CASE WHEN o_orderstatus = 'F' THEN CAST(n AS BIGINT) END AS ROWS_DB
FROM (SELECT *,
        CASE WHEN o_custkey % 25 = 0 THEN 0 ELSE 100 + o_orderkey % 900 END AS n,
        CASE WHEN o_custkey % 25 = 0 THEN 0 ELSE o_custkey % 50 END AS r
      FROM orders)
"""

STAGING_MMG = f"""
SELECT {_s('doc_id')} AS DOC_ID, lang AS LANG, source AS SOURCE,
       'CDR_MMG_' || {_s('doc_id % 5')} || '.csv' AS SOURCE_FILE,
       'MMG' AS SOURCE_DIR,
       {AS_OF} - to_minutes(CAST(doc_id AS BIGINT)) AS LOAD_TS
FROM documents
"""


# --------------------------------------------------------------------------
# Transform (SQL twin of operators.transform)
# --------------------------------------------------------------------------
def _blank(x: str) -> str:
    return f"(NULLIF(trim({x}), '') IS NULL)"


def _transform_sql(col: str, transform: str | None) -> str:
    if transform == "trim":
        return f"trim({col})"
    if transform == "upper":
        return f"upper(trim({col}))"
    if transform == "clean_msisdn":
        return f"replace(replace(replace(replace({col}, chr(13), ''), chr(10), ''), chr(9), ''), ' ', '')"
    return col


def string_sql(spec) -> str:
    e = _transform_sql(spec.source, spec.transform)
    if spec.max_length is not None:
        e = f"substr({e}, 1, {spec.max_length})"
    if not spec.required and isinstance(spec.default, str):
        e = f"COALESCE(NULLIF({e}, ''), '{spec.default}')"
    return f"NULLIF({e}, '')"


def number_sql(col: str, p: int, s: int) -> str:
    return (
        f"CASE WHEN regexp_matches({col}, '\\A[+-]?[0-9]+(\\.[0-9]+)?\\z') "
        f"THEN TRY_CAST({col} AS DECIMAL({p},{s})) END"
    )


def epoch_secs_sql(col: str, unit: str = "seconds") -> str:
    n = f"TRY_CAST({col} AS BIGINT)"
    secs = n if unit == "seconds" else f"(({n} + 500) // 1000)"
    ok = f"regexp_matches({col}, '\\A[0-9]+\\z') AND {n} IS NOT NULL AND {secs} <= 253402300799"
    return f"CASE WHEN {ok} THEN {secs} END"


def epoch_ts_sql(col: str, unit: str = "seconds") -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({epoch_secs_sql(col, unit)}))"


def dedup_sql(keys=OCC_DEDUP_KEYS, max_length: int | None = 40) -> str:
    e = "COALESCE(" + ", ".join(f"NULLIF(trim({k}), '')" for k in keys) + ")"
    return f"substr({e}, 1, {max_length})" if max_length else e


def reasons_sql(mapping=OCC_MAPPING, keys=OCC_DEDUP_KEYS, unit: str = "seconds") -> str:
    items = []
    for s in mapping:
        if s.required:
            items.append(f"CASE WHEN {_blank(s.source)} THEN 'REQUIRED_BLANK:{s.source}' END")
            if s.kind == "string" and s.target is not None:
                items.append(
                    f"CASE WHEN NOT {_blank(s.source)} AND {string_sql(s)} IS NULL "
                    f"THEN 'EMPTY_AFTER_CLEAN:{s.source}' END"
                )
        if s.kind == "timestamp":
            items.append(f"CASE WHEN {epoch_secs_sql(s.source, unit)} IS NULL THEN 'BAD_TIMESTAMP:{s.source}' END")
    items.append(f"CASE WHEN {dedup_sql(keys, None)} IS NULL THEN 'NO_DEDUP_KEY' END")
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


def overflow_sql(mapping=OCC_MAPPING) -> str:
    items = []
    for s in mapping:
        if s.kind == "number" and s.target is not None:
            guard = f"regexp_matches({s.source}, '\\A[+-]?[0-9]+(\\.[0-9]+)?\\z')"
            items.append(
                f"CASE WHEN {guard} AND TRY_CAST({s.source} AS DECIMAL({s.precision},{s.scale})) IS NULL "
                f"THEN '{s.target}' END"
            )
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


def detail_cols_sql(mapping=OCC_MAPPING, unit: str = "seconds") -> list[str]:
    out = []
    ts_src = None
    for s in mapping:
        if s.target is None:
            continue
        if s.kind == "number":
            out.append(f"{number_sql(s.source, s.precision, s.scale)} AS {s.target}")
        elif s.kind == "timestamp":
            ts_src = s.source
            out.append(f"{epoch_ts_sql(_transform_sql(s.source, s.transform), unit)} AS {s.target}")
        else:
            out.append(f"{string_sql(s)} AS {s.target}")
    out.append(f"CAST(hour({epoch_ts_sql(_transform_sql(ts_src, 'trim'), unit)}) AS INTEGER) AS START_HOUR")
    out.append(f"NULLIF(trim({ts_src}), '') AS ORIG_START_TIME")
    return out


def flagged_sql(source: str = "cdr_raw", mapping=OCC_MAPPING, keys=OCC_DEDUP_KEYS, unit: str = "seconds") -> str:
    cols = ",\n  ".join(detail_cols_sql(mapping, unit))
    return f"""
SELECT SOURCE_FILE, SOURCE_DIR, LOAD_TS, SOURCE_LINE,
  {dedup_sql(keys)} AS DEDUP_KEY,
  {cols},
  {reasons_sql(mapping, keys, unit)} AS REJECT_REASONS,
  {overflow_sql(mapping)} AS CONSTRAINT_VIOLATIONS
FROM {source}
"""


DETAIL_COLS = [s.target for s in OCC_MAPPING if s.target is not None] + ["START_HOUR", "ORIG_START_TIME"]
DECIMAL_COLS = {s.target for s in OCC_MAPPING if s.kind == "number"}


def detail_select(prefix: str = "", as_double: bool = False) -> str:
    """Detail columns, key column from DEDUP_KEY; decimals optionally as DOUBLE."""
    out = []
    for c in DETAIL_COLS:
        if c == "CHARGING_ID":
            out.append(f"{prefix}DEDUP_KEY AS CHARGING_ID")
        elif c in DECIMAL_COLS and as_double:
            out.append(f"CAST({prefix}{c} AS DOUBLE) AS {c}")
        else:
            out.append(f"{prefix}{c}")
    return ", ".join(out)


def base_ctes(unit: str = "seconds", source: str = "events") -> str:
    """cdr_raw -> flagged -> valid -> keep_first inserted detail (CTEs)."""
    return f"""
cdr_raw AS ({cdr_raw_sql(source)}),
detail_existing AS ({detail_existing_sql(source)}),
flagged AS ({flagged_sql('cdr_raw', unit=unit)}),
valid AS (SELECT * FROM flagged WHERE len(REJECT_REASONS) = 0),
first_per_key AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY DEDUP_KEY ORDER BY SOURCE_FILE, SOURCE_DIR, SOURCE_LINE,
                                 LOAD_TS, CHARGE_AMOUNT, A_MSISDN, FLEX_FLD3, EVENT_TYPE) AS rn
    FROM valid) WHERE rn = 1),
inserted AS (
  SELECT * FROM first_per_key f
  WHERE NOT EXISTS (SELECT 1 FROM detail_existing d WHERE d.CHARGING_ID = f.DEDUP_KEY)),
detail AS (SELECT {detail_select()}, SOURCE_FILE, SOURCE_DIR FROM inserted)
"""


def with_base(body: str, unit: str = "seconds", source: str = "events") -> str:
    return f"WITH {base_ctes(unit, source)}\n{body}"


# --------------------------------------------------------------------------
# Strict-ingest fixture (SQL twin of fixtures.csv_lines) and expected staging
# --------------------------------------------------------------------------
CSV_COLUMNS = [spec.source for spec in OCC_MAPPING]
DROPPED_17 = ("KEYWORD", "CALL_REFERENCE", "RECORD_ID")


def _file_cols(no: int) -> list[str]:
    if no == 15:
        return list(reversed(CSV_COLUMNS))
    if no == 17:
        return [c for c in CSV_COLUMNS if c not in DROPPED_17]
    return list(CSV_COLUMNS)


def _q(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '' ELSE '\"' || replace({c}, '\"', '\"\"') || '\"' END"


def _join(cols) -> str:
    return " || ',' || ".join(_q(c) for c in cols)


RAW13 = f"""
SELECT * REPLACE (CASE WHEN SOURCE_LINE % 20 = 13 THEN FLEX_FLD1 || chr(13) || 'y' ELSE FLEX_FLD1 END AS FLEX_FLD1),
       CAST(SOURCE_LINE % 20 AS INTEGER) AS FILE_NO,
       CAST(SOURCE_LINE // 20 + 1 AS BIGINT) AS R
FROM ({CDR_RAW})
"""

_LINE = f"""CASE WHEN FILE_NO = 15 THEN {_join(_file_cols(15))}
     WHEN FILE_NO = 17 THEN {_join(_file_cols(17))}
     WHEN FILE_NO = 3 AND R = 1 THEN {_join(CSV_COLUMNS[:-1])}
     WHEN FILE_NO = 5 AND R = 5 THEN {_join(CSV_COLUMNS)} || '\"'
     ELSE {_join(CSV_COLUMNS)} END"""

_LINE_NO = "CASE WHEN FILE_NO = 7 THEN 1 + R + (R - 1) // 10 ELSE 1 + R END"


def _header(no: int) -> str:
    cols = _file_cols(no)
    if no == 9:
        cols = ["UNKNOWN_FIELD_1" if c == "FLEX_FLD2" else c for c in cols]
    return ",".join(cols)


_HEADER = (
    "CASE FILE_NO "
    + " ".join(f"WHEN {n} THEN '{_header(n)}'" for n in (9, 15, 17))
    + f" ELSE '{_header(0)}' END"
)

CSV_LINES = f"""
WITH raw13 AS ({RAW13})
SELECT SOURCE_DIR, SOURCE_FILE AS FILE_NAME, CAST(1 AS BIGINT) AS LINE_NO, {_HEADER} AS LINE
FROM (SELECT DISTINCT SOURCE_DIR, SOURCE_FILE, FILE_NO FROM raw13)
UNION ALL
SELECT SOURCE_DIR, SOURCE_FILE, CAST({_LINE_NO} AS BIGINT), {_LINE} FROM raw13
UNION ALL
SELECT SOURCE_DIR, SOURCE_FILE, CAST({_LINE_NO} + 1 AS BIGINT), '' FROM raw13 WHERE FILE_NO = 7 AND R % 10 = 0
"""

# Expected outcome per file, known by construction.
FILE_ROUTING = f"""
SELECT SOURCE_DIR, SOURCE_FILE AS FILE_NAME,
  CASE WHEN FILE_NO IN (3, 5, 9) THEN 'ERROR' ELSE 'SUCCESS' END AS STATUS,
  CASE FILE_NO WHEN 3 THEN 'LOAD_ERROR' WHEN 5 THEN 'LOAD_ERROR' WHEN 9 THEN 'WHITELIST_ERROR' END AS ERROR_CLASS,
  CASE FILE_NO WHEN 3 THEN 'LOAD_ERROR: Wrong column count at data line 2 got=24 expected=25'
               WHEN 5 THEN 'LOAD_ERROR: Broken line (unbalanced quotes) at data line 6'
               WHEN 9 THEN 'WHITELIST_ERROR: Unknown columns: UNKNOWN_FIELD_1' END AS MESSAGE,
  CAST(CASE FILE_NO WHEN 3 THEN 2 WHEN 5 THEN 6 END AS BIGINT) AS FIRST_BAD_LINE,
  CAST(COUNT(*) AS BIGINT) AS ROWS_CSV
FROM ({RAW13}) GROUP BY SOURCE_DIR, SOURCE_FILE, FILE_NO
"""


def staged_sql(load_ts: str = AS_OF) -> str:
    cols = []
    for c in CSV_COLUMNS:
        e = f"NULLIF({c}, '')"
        if c in DROPPED_17:
            e = f"CASE WHEN FILE_NO = 17 THEN NULL ELSE {e} END"
        cols.append(f"{e} AS {c}")
    return (
        f"SELECT {', '.join(cols)}, SOURCE_FILE, SOURCE_DIR, {load_ts} AS LOAD_TS, "
        f"CAST({_LINE_NO} AS BIGINT) AS SOURCE_LINE FROM ({RAW13}) WHERE FILE_NO NOT IN (3, 5, 9)"
    )


def load_ctes(staged: str) -> str:
    """staged -> flagged -> valid -> keep_first -> inserted (CTEs)."""
    return f"""
staged AS ({staged}),
detail_existing AS ({DETAIL_EXISTING}),
flagged AS ({flagged_sql('staged')}),
valid AS (SELECT * FROM flagged WHERE len(REJECT_REASONS) = 0),
first_per_key AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY DEDUP_KEY ORDER BY SOURCE_FILE, SOURCE_DIR, SOURCE_LINE) AS rn
    FROM valid) WHERE rn = 1),
inserted AS (
  SELECT * FROM first_per_key f
  WHERE NOT EXISTS (SELECT 1 FROM detail_existing d WHERE d.CHARGING_ID = f.DEDUP_KEY))
"""
