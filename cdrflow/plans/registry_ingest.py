"""Registered ingest queries: strict CSV handling over the lines fixture."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cdrflow.mapping import OCC_MAPPING
from cdrflow.operators import merge as MG
from cdrflow.operators import transform as TR
from cdrflow.plans import fixtures as FX
from cdrflow.plans import oracle_sql as O
from cdrflow.plans.registry import register
from cdrflow.sources import csv_ingest as CI
from cdrflow.sources import tables as TB
from cdrflow.sources.landing import number_lines

STAGING_COLUMNS = [s.source for s in OCC_MAPPING]


def ingested(spark: SparkSession, sf_dir: str):
    """(header info, parsed lines, routing, staging rows); lines are parsed once and written, as in a load run."""
    info = CI.header_info(FX.csv_headers(spark, sf_dir), STAGING_COLUMNS)
    parsed = TB.shared_copy(CI.parse_lines(FX.csv_lines(spark, sf_dir), info, STAGING_COLUMNS), "parsed")
    routing = CI.file_routing(info, parsed)
    return info, parsed, routing, CI.staging_rows(parsed, routing, STAGING_COLUMNS, FX.ntz(FX.AS_OF))


def numbered(spark: SparkSession, sf_dir: str):
    """The scan's own numbering over raw lines: (lines, per-file facts, headers)."""
    return number_lines(FX.csv_raw_lines(spark, sf_dir))


register("csv_lines", O.CSV_LINES)(
    lambda spark, d: numbered(spark, d)[0].select("SOURCE_DIR", "FILE_NAME", "LINE_NO", "LINE")
)

register(
    "csv_header",
    "WITH raw13 AS (" + O.RAW13 + ") SELECT DISTINCT SOURCE_DIR, SOURCE_FILE AS FILE_NAME, "
    "CAST(len(string_split(" + O._HEADER + ", ',')) AS INTEGER) AS N_COLS, " + O._HEADER + " AS HEADER_COLUMNS FROM raw13",
)(
    lambda spark, d: CI.header_info(numbered(spark, d)[2], STAGING_COLUMNS).select(
        "SOURCE_DIR", "FILE_NAME", "N_COLS", F.array_join("HEADER_RAW", ",").alias("HEADER_COLUMNS")
    )
)

register(
    "header_sanitize",
    "WITH raw13 AS (" + O.RAW13 + ") SELECT DISTINCT SOURCE_DIR, SOURCE_FILE AS FILE_NAME, "
    + O._HEADER + " AS STORAGE_COLUMNS FROM raw13",
)(
    lambda spark, d: CI.header_info(numbered(spark, d)[2], None, "permissive").select(
        "SOURCE_DIR", "FILE_NAME", F.array_join("HEADER_COLS", ",").alias("STORAGE_COLUMNS")
    )
)

register(
    "whitelist_check",
    "WITH raw13 AS (" + O.RAW13 + ") SELECT DISTINCT SOURCE_DIR, SOURCE_FILE AS FILE_NAME, FILE_NO <> 9 AS VALID, "
    "CASE WHEN FILE_NO = 9 THEN 'UNKNOWN_FIELD_1' ELSE '' END AS UNKNOWN_COLUMNS FROM raw13",
)(
    lambda spark, d: CI.header_info(FX.csv_headers(spark, d), STAGING_COLUMNS).select(
        "SOURCE_DIR", "FILE_NAME", (F.size("UNKNOWN_COLUMNS") == 0).alias("VALID"),
        F.array_join("UNKNOWN_COLUMNS", ", ").alias("UNKNOWN_COLUMNS"),
    )
)


@register(
    "csv_quote_check",
    "SELECT SOURCE_DIR, FILE_NAME, COUNT(*) AS ODD_LINES, MIN(LINE_NO) AS FIRST_ODD_LINE FROM ("
    + O.CSV_LINES + ") WHERE (length(LINE) - length(replace(LINE, '\"', ''))) % 2 <> 0 GROUP BY SOURCE_DIR, FILE_NAME",
)
def q_csv_quote_check(spark, sf_dir):
    from cdrflow.functions.csvtext import odd_quotes

    return (
        FX.csv_lines(spark, sf_dir)
        .where(odd_quotes(F.col("LINE")))
        .groupBy("SOURCE_DIR", "FILE_NAME")
        .agg(F.count(F.lit(1)).alias("ODD_LINES"), F.min("LINE_NO").alias("FIRST_ODD_LINE"))
    )


register(
    "csv_strict_parse",
    "WITH r AS (" + O.FILE_ROUTING + ") SELECT SOURCE_DIR, FILE_NAME, FIRST_BAD_LINE AS LINE_NO, "
    "substr(MESSAGE, 13) AS LINE_ERROR FROM r WHERE ERROR_CLASS = 'LOAD_ERROR'",
)(
    lambda spark, d: ingested(spark, d)[1]
    .where(F.col("LINE_ERROR").isNotNull())
    .select("SOURCE_DIR", "FILE_NAME", "LINE_NO", "LINE_ERROR")
)

register("file_routing", O.FILE_ROUTING)(lambda spark, d: ingested(spark, d)[2])

register("staging_load", O.staged_sql())(lambda spark, d: ingested(spark, d)[3])

register(
    "staging_union",
    "SELECT SOURCE_FILE, COUNT(*) AS ROWS_STAGED, COUNT(KEYWORD) AS KEYWORD_SET, COUNT(RECORD_ID) AS RECORD_ID_SET, "
    "COUNT(DATASOURCE) AS DATASOURCE_SET, COUNT(*) FILTER (WHERE FLEX_FLD1 LIKE '%' || chr(13) || '%') AS CR_IN_FIELD "
    "FROM (" + O.staged_sql() + ") GROUP BY SOURCE_FILE",
)(
    lambda spark, d: ingested(spark, d)[3]
    .groupBy("SOURCE_FILE")
    .agg(
        F.count(F.lit(1)).alias("ROWS_STAGED"),
        F.count("KEYWORD").alias("KEYWORD_SET"),
        F.count("RECORD_ID").alias("RECORD_ID_SET"),
        F.count("DATASOURCE").alias("DATASOURCE_SET"),
        F.count_if(F.col("FLEX_FLD1").contains("\r")).alias("CR_IN_FIELD"),
    )
)

_RECON_SQL = (
    "WITH " + O.load_ctes(O.staged_sql()) + ", r AS (" + O.FILE_ROUTING + "), "
    "n AS (SELECT SOURCE_DIR, FILE_NAME, COUNT(*) AS LINES_DATA FROM (" + O.CSV_LINES + ") WHERE LINE_NO > 1 AND LINE <> '' GROUP BY ALL), "
    "s AS (SELECT SOURCE_FILE, COUNT(*) AS N, COUNT(*) FILTER (WHERE len(REJECT_REASONS) > 0) AS REJ FROM flagged GROUP BY SOURCE_FILE), "
    "i AS (SELECT SOURCE_FILE, COUNT(*) AS N FROM inserted GROUP BY SOURCE_FILE), "
    "d AS (SELECT SOURCE_FILE, COUNT(*) AS N FROM flagged f WHERE len(REJECT_REASONS) = 0 AND NOT EXISTS "
    "(SELECT 1 FROM inserted j WHERE j.SOURCE_FILE = f.SOURCE_FILE AND j.SOURCE_LINE = f.SOURCE_LINE) GROUP BY SOURCE_FILE) "
    "SELECT SOURCE_DIR, FILE_NAME, STATUS, LINES_DATA, ROWS_CSV, ROWS_STAGED, INSERTED, DUPLICATES, REJECTED, "
    "LINES_DATA = ROWS_CSV AND (STATUS <> 'SUCCESS' AND ROWS_STAGED = 0 OR ROWS_STAGED = ROWS_CSV "
    "AND ROWS_STAGED = INSERTED + DUPLICATES + REJECTED) AS RECONCILED FROM ("
    "SELECT r.SOURCE_DIR, r.FILE_NAME, r.STATUS, CAST(n.LINES_DATA AS BIGINT) AS LINES_DATA, r.ROWS_CSV, "
    "CAST(COALESCE(s.N, 0) AS BIGINT) AS ROWS_STAGED, CAST(COALESCE(i.N, 0) AS BIGINT) AS INSERTED, "
    "CAST(COALESCE(d.N, 0) AS BIGINT) AS DUPLICATES, CAST(COALESCE(s.REJ, 0) AS BIGINT) AS REJECTED "
    "FROM r JOIN n USING (SOURCE_DIR, FILE_NAME) LEFT JOIN s ON s.SOURCE_FILE = r.FILE_NAME "
    "LEFT JOIN i ON i.SOURCE_FILE = r.FILE_NAME LEFT JOIN d ON d.SOURCE_FILE = r.FILE_NAME)"
)


def reconcile(lines, routing, staged, flagged, inserted):
    """Per file: physical data lines, parsed, staged, inserted, duplicate and rejected rows, each counted on its own.

    Duplicates are the valid rows that are not among the inserted ones, found
    row by row.  RECONCILED: parsed = physical, and for a good file staged =
    parsed = inserted + duplicates + rejected; of another file nothing is staged.
    """
    def per_file(rows, name):
        return rows.groupBy("SOURCE_DIR", F.col("SOURCE_FILE").alias("FILE_NAME")).agg(F.count(F.lit(1)).alias(name))

    place = ["SOURCE_DIR", "SOURCE_FILE", "SOURCE_LINE"]
    data = lines.where((F.col("LINE_NO") > 1) & (F.col("LINE") != ""))
    duplicates = TR.valid_rows(flagged).select(*place).join(inserted.select(*place), place, "left_anti")
    out = routing.join(data.groupBy("SOURCE_DIR", "FILE_NAME").agg(F.count(F.lit(1)).alias("LINES_DATA")), CI.FILE, "left")
    names = ["ROWS_STAGED", "INSERTED", "DUPLICATES", "REJECTED"]
    for rows, name in zip((staged, inserted, duplicates, TR.rejects(flagged)), names):
        out = out.join(per_file(rows, name), CI.FILE, "left")
    out = out.select(
        *CI.FILE, "STATUS", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("LINES_DATA", "ROWS_CSV", *names)]
    )
    whole = (F.col("ROWS_STAGED") == F.col("ROWS_CSV")) & (
        F.col("ROWS_STAGED") == F.col("INSERTED") + F.col("DUPLICATES") + F.col("REJECTED")
    )
    none = (F.col("STATUS") != "SUCCESS") & (F.col("ROWS_STAGED") == 0)
    return out.withColumn("RECONCILED", (F.col("LINES_DATA") == F.col("ROWS_CSV")) & (none | whole))


@register("row_reconcile", _RECON_SQL)
def q_row_reconcile(spark, sf_dir):
    """Lines, parsed and flagged rows are written once, as in a load run, and all counts read them."""
    lines = TB.shared_copy(FX.csv_lines(spark, sf_dir), "reconcile-lines")
    info = CI.header_info(CI.file_headers(lines), STAGING_COLUMNS)
    parsed = TB.shared_copy(CI.parse_lines(lines, info, STAGING_COLUMNS), "reconcile-parsed")
    routing = TB.shared_copy(CI.file_routing(info, parsed), "reconcile-routing")
    staged = CI.staging_rows(parsed, routing, STAGING_COLUMNS, FX.ntz(FX.AS_OF))
    flagged = TB.shared_copy(TR.flag(staged, keep=["SOURCE_LINE"]), "reconcile-flagged")
    inserted, _ = MG.merge_insert_absent(
        TR.valid_rows(flagged), FX.detail_existing(spark, sf_dir), "DEDUP_KEY", "CHARGING_ID", "keep_first", ("SOURCE_LINE",)
    )
    inserted = TB.shared_copy(inserted.select("SOURCE_DIR", "SOURCE_FILE", "SOURCE_LINE"), "reconcile-inserted")
    return reconcile(lines, routing, staged, flagged, inserted)


# Messy header names per event type: case variants, blanks, a leading digit,
# punctuation, an over-long name, a non-ASCII letter, an empty name, a repeat.
def _messy_names(et):
    return F.array(
        et, F.upper(et), F.concat(F.lit(" "), et, F.lit(" ")), F.concat(F.lit("1"), et),
        F.concat(et, F.lit("-x")), F.concat(et, F.lit("_x")), F.repeat(et, 8), F.lit("ß"), F.lit(""), et,
    )


_MESSY_SQL = """
WITH RECURSIVE h AS (
  SELECT DISTINCT event_type AS ET,
    [event_type, upper(event_type), ' ' || event_type || ' ', '1' || event_type, event_type || '-x',
     event_type || '_x', repeat(event_type, 8), 'ß', '', event_type] AS NAMES
  FROM events),
b AS (
  SELECT ET, list_transform(NAMES, lambda x: substr(
    CASE WHEN regexp_matches(regexp_replace(upper(regexp_replace(x, '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g'), '^[A-Z]')
         THEN regexp_replace(upper(regexp_replace(x, '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g')
         ELSE 'C_' || regexp_replace(upper(regexp_replace(x, '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g') END,
    1, 30)) AS BASES
  FROM h),
r(ET, BASES, POS, USED) AS (
  SELECT ET, BASES, 0, []::VARCHAR[] FROM b
  UNION ALL
  SELECT ET, BASES, POS + 1,
    list_append(USED, list_filter(
      list_transform(range(0, len(USED) + 1), lambda i: CASE WHEN i = 0 THEN BASES[POS + 1]
        ELSE substr(BASES[POS + 1], 1, 30 - length(printf('_%02d', i))) || printf('_%02d', i) END),
      lambda c: NOT list_contains(USED, c))[1])
  FROM r WHERE POS < len(BASES))
SELECT ET AS EVENT_TYPE, array_to_string(USED, ',') AS STORAGE_COLUMNS FROM r WHERE POS = len(BASES)
"""


@register("header_sanitize_messy", _MESSY_SQL)
def q_header_sanitize_messy(spark, sf_dir):
    from cdrflow.functions.csvtext import sanitize_columns

    ets = FX.event_source(spark, sf_dir).select(F.col("event_type").alias("EVENT_TYPE")).distinct()
    return ets.select(
        "EVENT_TYPE", F.array_join(sanitize_columns(_messy_names(F.col("EVENT_TYPE"))), ",").alias("STORAGE_COLUMNS")
    )
